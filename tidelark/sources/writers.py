"""Sinks: CSV, JSON lines, reports, staged promotion, fingerprints."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MOST_FINDINGS = 2000


def union_columns(frames: Sequence[DataFrame], required: Sequence[str] = ()) -> DataFrame:
    """Union by name, required columns first, the rest in order of first sight."""
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return out.select(*required, *[c for c in out.columns if c not in required])


def nested_to_json(df: DataFrame) -> DataFrame:
    """Arrays, maps and structs as JSON text, for CSV."""
    return df.withColumns({f.name: F.to_json(f.name) for f in df.schema.fields if f.dataType.typeName() in ("array", "map", "struct")})


def write_csv(df: DataFrame, path: str, append: bool = False) -> None:
    nested_to_json(df).write.mode("append" if append else "overwrite").option("header", True).option("quote", '"').option("escape", '"').option("emptyValue", "").csv(path)


def write_jsonl(df: DataFrame, path: str, append: bool = False) -> None:
    df.write.mode("append" if append else "overwrite").json(path)


def report_frame(findings: DataFrame, order: Sequence[str], most: int = MOST_FINDINGS) -> tuple[DataFrame, DataFrame]:
    """(the first ``most`` findings, one row: total and whether the list is cut)."""
    total = findings.agg(F.count("*").alias("total")).withColumn("truncated", F.col("total") > most)
    return findings.orderBy(*order).limit(most), total


def promote(df: DataFrame, path: str, gate: DataFrame) -> bool:
    """Write beside ``path``; if every row of ``gate`` has passed, the version takes the place of ``path``.

    The old version is set aside by a rename and deleted last, so at no time is there no whole version: a crash between
    the two renames leaves it under ``path`` + "_previous", and the next call (or ``recovered``) puts it back first.
    """
    spark = df.sparkSession
    fs, at = _files(spark, path)
    recovered(spark, path)
    df.write.mode("overwrite").parquet(f"{path}_candidate")
    if gate.filter("NOT passed").limit(1).count():
        return False
    if fs.exists(at("")):
        _renamed(fs, at(""), at("_previous"))
    _renamed(fs, at("_candidate"), at(""))
    fs.delete(at("_previous"), True)
    return True


def recovered(spark: SparkSession, path: str) -> bool:
    """Whether a promotion that broke off had to be undone."""
    fs, at = _files(spark, path)
    if not fs.exists(at("_previous")):
        return False
    if fs.exists(at("")):  # it broke off after the new version was in place
        fs.delete(at("_previous"), True)
        return False
    _renamed(fs, at("_previous"), at(""))
    return True


def _files(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    return jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), lambda tail: jvm.org.apache.hadoop.fs.Path(path + tail)


def _renamed(fs, source, to) -> None:
    if not fs.rename(source, to):
        raise OSError(f"{source} could not be renamed to {to}")


def markdown(title: str, summary: Mapping[str, object], rows: Sequence[Mapping[str, object]]) -> str:
    """A report of collected aggregates."""
    lines = [f"# {title}", "", *(f"- {k}: {v}" for k, v in summary.items()), ""]
    if rows:
        names = list(rows[0])
        lines += ["| " + " | ".join(names) + " |", "|" + "---|" * len(names), *("| " + " | ".join(str(r[n]) for n in names) + " |" for r in rows)]
    return "\n".join(lines) + "\n"


def write_yaml(rows: Sequence[Mapping[str, object]], meta: Mapping[str, object]) -> str:
    import yaml

    return yaml.safe_dump({"meta": dict(meta), "entries": [dict(r) for r in rows]}, allow_unicode=True, sort_keys=False)


def fingerprints(spark: SparkSession, path: str) -> DataFrame:
    """path, size_bytes, modified, sha256 of files, on the executors."""
    return spark.read.format("binaryFile").load(path).select("path", F.col("length").alias("size_bytes"), F.col("modificationTime").alias("modified"), F.sha2("content", 256).alias("sha256"))


def tree_drift(a: DataFrame, b: DataFrame, path: str = "path", digest: str = "sha256") -> DataFrame:
    """Files missing, extra or changed between two fingerprint tables."""
    from ..operators.relational import diff

    return diff(a, b, path, digest).select(path, F.when(F.col("change") == "deleted", "missing").when(F.col("change") == "added", "extra").otherwise("drifted").alias("state"))


def to_json(payload: object) -> str:
    return json.dumps(payload, ensure_ascii=False, indent=2)
