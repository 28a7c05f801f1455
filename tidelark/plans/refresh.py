"""Incremental refresh: glossary change, impacted rows, tasks, gated output; and the metrics plan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.estimate import usage
from ..functions.models import Translator, stub_translator, translate
from ..functions.text import tokens_signature
from ..operators.analytics import call_metrics
from ..operators.gates import refresh_gate
from ..operators.glossary import row_impacts
from ..operators.helpers import keep_last
from ..operators.relational import diff, overlay, priced


def refresh(rows: DataFrame, old_terms: DataFrame, new_terms: DataFrame, model: Translator = stub_translator) -> dict[str, DataFrame]:
    """rows: string_id, source, target, module_tag; terms: term, target.  Exact terms are filled from the glossary, the rest asked of the model."""
    delta = diff(old_terms, new_terms, "term", "target").select("term", F.coalesce("before", F.lit("")).alias("old"), F.coalesce("after", F.lit("")).alias("new"), "change")
    impacts = row_impacts(rows, delta, "string_id", "source", "target", "module_tag")
    tasks = rows.join(impacts.filter("action IN ('auto_refresh', 'retranslate')"), "string_id")
    exact = tasks.join(new_terms.select(F.col("term").alias("source"), F.col("target").alias("_exact")), "source", "left")
    filled = exact.filter("_exact IS NOT NULL").select("string_id", F.col("_exact").alias("target"))
    asked = translate(exact.filter("_exact IS NULL"), "string_id", "source", model).filter("status = 'ok'").select("string_id", F.col("translated").alias("target"))
    candidate = overlay(rows, filled.unionByName(asked), "string_id")
    signed = lambda df: df.withColumn("_sig", F.to_json(F.map_from_entries(F.array_sort(F.map_entries(tokens_signature(F.col("source")))))))
    gate = refresh_gate(signed(rows), signed(candidate), "string_id", "_sig", candidate.filter("trim(target) = ''"))
    return {"delta": delta, "impacts": impacts, "candidate": candidate, "gate": gate}


def metrics(progress: DataFrame, trace: DataFrame, rates: DataFrame, default: float) -> DataFrame:
    """Progress events with usage from their own counts, else from the last trace of their request, priced, at all levels."""
    last = keep_last(trace.select("request_id", "seq", F.col("prompt_tokens").alias("_p"), F.col("completion_tokens").alias("_c"), "req_chars", "resp_chars"), ["request_id"], "seq").drop("seq")
    none = F.lit(None).cast("struct<prompt_tokens:bigint,completion_tokens:bigint>")
    j = progress.join(last, "request_id", "left").withColumn("_u", usage(none, F.coalesce("prompt_tokens", "_p"), F.coalesce("completion_tokens", "_c"), F.col("req_chars"), F.col("resp_chars")))
    j = priced(j.select("*", F.col("_u.prompt").alias("prompt"), F.col("_u.completion").alias("completion")), rates, "model", default)
    return call_metrics(j.withColumn("cost", (F.col("prompt") + F.col("completion")) * F.col("rate") / 1e6), F.col("status") == "ok")
