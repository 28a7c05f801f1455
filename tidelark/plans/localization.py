"""The string pipeline as one DAG: freeze, translate, check, repair in rounds, restore, deliver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.models import Translator, stub_translator, translate
from ..functions.text import fix_printf_spacing, restore_tokens, sanitize_punctuation, unknown_tokens
from ..operators.findings import hard_findings, repair_failures, report
from ..operators.freeze import freeze
from ..operators.gates import row_counts, target_coverage
from ..operators.relational import pending

PUNCTUATION = (("...", "…"),)


def mapping_column(mapping: DataFrame, rows: DataFrame, text: str) -> DataFrame:
    """``rows`` with the part of the token map their text needs (a join on tokens; the map is not gathered)."""
    tokens = rows.select("string_id", F.explode(F.array_distinct(F.regexp_extract_all(text, F.lit("⟦(PH_\\d+|TAG_\\d+)⟧"), F.lit(1)))).alias("token"))
    own = tokens.join(mapping, "token").groupBy("string_id").agg(F.map_from_entries(F.collect_list(F.struct("token", "original"))).alias("mapping"))
    empty = F.create_map().cast("map<string,string>")
    return rows.join(own, "string_id", "left").withColumn("mapping", F.coalesce("mapping", empty))


def repair(rows: DataFrame, model: Translator, rounds: int = 3) -> DataFrame:
    """Rounds over the rows that fail their checks; a repair stands only if it passes; states: ok, repaired, escalated.

    Written to the checkpoint folder each round: the model's answers must not be asked for twice.
    """
    from ..streaming.state import shared_checkpoint

    out = rows.withColumn("state", F.when(F.size(repair_failures(F.col("tokenized"), F.col("target"), F.lit(0))) == 0, "ok").otherwise("pending"))
    for _ in range(rounds):
        out = shared_checkpoint(out)
        if not out.filter("state = 'pending'").limit(1).count():
            break
        asked = translate(out.filter("state = 'pending'"), "string_id", "tokenized", model).select("string_id", F.col("translated").alias("_new"))
        better = F.col("_new").isNotNull() & (F.size(repair_failures(F.col("tokenized"), F.col("_new"), F.lit(0))) == 0)
        out = out.join(asked, "string_id", "left").withColumns({"target": F.when(better, F.col("_new")).otherwise(F.col("target")), "state": F.when(better, "repaired").otherwise(F.col("state"))}).drop("_new")
    return out.withColumn("state", F.when(F.col("state") == "pending", "escalated").otherwise(F.col("state")))


def deliver(strings: DataFrame, model: Translator = stub_translator, rounds: int = 3, targets: tuple[str, ...] = ("target_ru",)) -> dict[str, DataFrame]:
    """From (string_id, seq, source_zh) to the delivered rows, findings, their report, offenders and coverage.

    Every input row is in the output; a row with a token unknown to the map is an offender, not dropped.
    """
    from ..streaming.state import shared_checkpoint

    frozen, mapping = freeze(strings, "source_zh", "seq")
    mapping = shared_checkpoint(mapping)
    answered = shared_checkpoint(translate(frozen, "string_id", "tokenized", model))
    rows = frozen.join(answered.select("string_id", F.coalesce("translated", F.lit("")).alias("target")), "string_id", "left").fillna("", ["target"])
    mended = repair(rows, model, rounds)
    findings = hard_findings(mended, "tokenized", "target")
    known = mapping_column(mapping, mended, "target")
    offenders = known.select("string_id", F.explode(unknown_tokens(F.col("target"), F.col("mapping"))).alias("token"))
    text = fix_printf_spacing(sanitize_punctuation(restore_tokens(F.col("target"), F.col("mapping")), PUNCTUATION))
    final = known.withColumn("rehydrated_text", text).drop("mapping").withColumns({t: F.col("rehydrated_text") for t in targets})
    return {"delivered": final, "findings": findings, "report": report(findings), "offenders": offenders, "coverage": target_coverage(final, "rehydrated_text"), "counts": row_counts(input=strings, final=final), "token_map": mapping, "lost": pending(strings, final, "string_id")}
