"""The smaller script computations: questionnaires, profiles, template sets, result consolidation, stress reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import missing_sections, text_or_empty
from .relational import bucketed_sample, overlay


def parse_questionnaire(lines: DataFrame, document: str, line_no: str, text: str) -> DataFrame:
    """document, section, key, value, checked: the line grammar of a style questionnaire.

    ``## name`` opens a section (carried forward), ``- [x] value`` is a checkbox, ``key: value`` a field, ``- value`` a bullet.
    """
    t = F.trim(text_or_empty(F.col(text)))
    heading = F.when(t.startswith("#"), F.trim(F.regexp_replace(t, "^#+", "")))
    w = Window.partitionBy(document).orderBy(line_no).rowsBetween(Window.unboundedPreceding, 0)
    rows = lines.withColumns({"_t": t, "section": F.coalesce(F.last(heading, ignorenulls=True).over(w), F.lit(""))})
    t = F.col("_t")
    rows = rows.filter(~t.startswith("#") & (t != ""))
    box, field = t.rlike("^[-*] \\[[ xX]\\]"), t.rlike("^[-*]?\\s*[^:\\[\\]]+:")
    key = F.when(box, "choice").when(field, F.trim(F.regexp_extract(t, "^[-*]?\\s*([^:]+):", 1))).otherwise("item")
    value = F.when(box, F.trim(F.regexp_replace(t, "^[-*] \\[[ xX]\\]", ""))).when(field, F.trim(F.regexp_replace(t, "^[-*]?\\s*[^:]+:", ""))).otherwise(F.trim(F.regexp_replace(t, "^[-*]", "")))
    return rows.select(document, line_no, "section", key.alias("key"), value.alias("value"), t.rlike("^[-*] \\[[xX]\\]").alias("checked"))


def profile_issues(answers: DataFrame, document: str, required: Sequence[str]) -> DataFrame:
    """Required keys that a document leaves out or blank."""
    have = answers.filter(F.trim("value") != "").groupBy(document).agg(F.collect_set("key").alias("_k"))  # keys of one questionnaire
    return have.select(document, F.explode(F.array_except(F.array(*map(F.lit, required)), F.col("_k"))).alias("missing"))


def section_sync(docs: DataFrame, key: str, text: str, sections: Sequence[str]) -> DataFrame:
    """Documents that lack a section."""
    return docs.withColumn("_m", missing_sections(F.col(text), sections)).filter(F.size("_m") > 0).select(key, F.array_join("_m", ",").alias("missing"))


def stress_template(rows: DataFrame, key: str, text: str, placeholder: Column) -> DataFrame:
    """Longest 12, short 72, middling 24, with placeholders 12, none taken twice."""
    n = F.length(text_or_empty(F.col(text)))
    buckets = [("longest", F.lit(True), 12), ("short", (n > 0) & (n <= 6), 72), ("middle", n.between(20, 60), 24), ("placeholder", placeholder, 12)]
    return bucketed_sample(rows, key, buckets, [F.desc(n), F.col(key)])


def gate_rows(spark: SparkSession, rows: Sequence[tuple[str, str]]) -> DataFrame:
    """A fixed asset of a few rows."""
    return spark.createDataFrame(list(rows), "string_id string, source_zh string")


def consolidated(results: DataFrame, one_model: DataFrame, key: str, size: str, least: int = 10) -> DataFrame:
    """Results with one model's laid over, and whether each qualifies."""
    return overlay(results, one_model, key, forced=(size,)).withColumn("qualified", F.coalesce(F.col(size) >= least, F.lit(False)))


def stress_report(phases: DataFrame, artifacts: DataFrame, calls: DataFrame, phase: str, path: str) -> DataFrame:
    """Per phase: PASS iff its artifact exists, with its calls' latency and cost; go iff all pass."""
    seen = artifacts.select(path).distinct().withColumn("_hit", F.lit(True))
    roll = calls.groupBy(phase).agg(F.sum("latency_ms").alias("latency_ms"), F.round(F.sum("cost"), 6).alias("cost"))
    out = phases.join(seen, path, "left").join(roll, phase, "left").withColumn("status", F.when(F.col("_hit"), "PASS").otherwise("FAIL")).drop("_hit")
    go = out.agg(F.bool_and(F.col("status") == "PASS").alias("go"))
    return out.join(F.broadcast(go))


def checkpoint_cut(done: DataFrame, order: str, n: int) -> DataFrame:
    return done.orderBy(order).limit(n)
