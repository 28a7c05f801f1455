"""All registered queries and their DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import analytics, governance, rules, scans, text  # noqa: F401  (they register their queries)
from .base import ORACLES, QUERIES


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return QUERIES["q10_findings_report"](spark, sf_dir)
