"""Glossary lifecycle: compile, review, patch, change impact."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.classify import cases, content_class, rank_of, recommended_action, risk_level
from ..functions.policy import SCOPE_RANK
from .helpers import contains_join, keep_first, top_n


def compile_glossary(entries: DataFrame, term: str, target: str, scope: str, seq: str) -> DataFrame:
    """One entry a term: of conflicting targets the highest scope's (ties: first), else the first; with a flag."""
    flagged = entries.join(entries.groupBy(term).agg((F.count_distinct(target) > 1).alias("conflict")), term)
    rank = F.when(F.col("conflict"), rank_of(F.col(scope), SCOPE_RANK)).otherwise(0)
    return top_n(flagged, [term], [F.desc(rank), F.col(seq)])


def apply_review(queue: DataFrame, existing: DataFrame, term: str, suggested: str, final: str, decision: str, seq: str) -> DataFrame:
    """The queue with an outcome: approved, edited, rejected, skipped, or duplicate (of an existing pair or an earlier row)."""
    d = F.lower(F.trim(F.coalesce(F.col(decision), F.lit(""))))
    value = F.when((d == "edit") & (F.coalesce(F.col(final), F.lit("")) != ""), F.col(final)).otherwise(F.col(suggested))
    rows = queue.withColumns({"_d": d, "target": value})
    have = existing.select(F.col(term), F.col("target"), F.lit(True).alias("_have")).distinct()
    wanted = F.col("_d").isin("approve", "edit")
    nth = F.row_number().over(Window.partitionBy(term, "target", wanted).orderBy(seq))
    out = rows.withColumn("_nth", nth).join(have, [term, "target"], "left")
    outcome = cases([(F.col("_d") == "reject", "rejected"), (~wanted, "skipped"), (F.col("_have") | (F.col("_nth") > 1), "duplicate"), (F.col("_d") == "edit", "edited")], "approved")
    return out.withColumn("outcome", outcome).drop("_d", "_nth", "_have")


def patch_append(entries: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    return entries.unionByName(rows.join(entries.select(*keys).distinct(), list(keys), "left_anti"), allowMissingColumns=True)


def patch_update(entries: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """Non-null values of the patch (one row a key) laid over."""
    shared = [c for c in rows.columns if c != key and c in entries.columns]
    p = rows.select(key, *[F.col(c).alias(f"_p_{c}") for c in shared])
    return entries.join(p, key, "left").withColumns({c: F.coalesce(f"_p_{c}", c) for c in shared}).select(*entries.columns)


def patch_remove(entries: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    return entries.join(rows.select(key).distinct(), key, "left_anti")


def auto_approve(proposals: DataFrame, confidence: str, least: float = 0.9) -> DataFrame:
    return proposals.filter(F.col(confidence) >= least).withColumn("status", F.lit("approved"))


def review_queue(proposals: DataFrame, term: str, target: str) -> DataFrame:
    blank = F.lit("")
    return proposals.select(term, F.col(target).alias("suggested"), "scope", "support", "confidence", blank.alias("decision"), blank.alias("final"), blank.alias("note"))


def merge_sources(sources: Sequence[tuple[str, DataFrame]], keys: Sequence[str], seq: str) -> DataFrame:
    """Sources under their scope, the first row of each key."""
    tagged = [s.withColumns({"scope": F.lit(name), "_source": F.lit(i)}) for i, (name, s) in enumerate(sources)]
    out = tagged[0]
    for t in tagged[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    return keep_first(out.withColumn("_at", F.struct("_source", seq)), list(keys), "_at").drop("_source", "_at")


def style_conflicts(entries: DataFrame, banned: DataFrame, target: str, word: str) -> DataFrame:
    """Approved entries whose target is a banned word."""
    return entries.filter("status = 'approved'").join(banned.select(F.lower(word).alias("_w")).distinct(), F.lower(target) == F.col("_w"), "left_semi")


def preferences(entries: DataFrame, term: str, target: str, compact: Column, seq: str) -> DataFrame:
    """Per term the first standard and the first compact target."""
    first = lambda flag: F.min_by(F.when(flag, F.col(target)), F.when(flag, F.col(seq)))
    return entries.groupBy(term).agg(first(~compact).alias("standard"), first(compact).alias("compact"))


def prompt_summary(entries: DataFrame, term: str, target: str, compact: Column, seq: str, n: int = 40) -> DataFrame:
    """Two lines at most: the first n compact and the first n standard pairs."""
    kind = F.when(compact, "compact").otherwise("standard")
    top = top_n(entries.withColumn("kind", kind), ["kind"], [F.col(seq)], n)
    pairs = F.array_sort(F.collect_list(F.struct(seq, F.concat_ws(" = ", term, target).alias("p"))))
    return top.groupBy("kind").agg(F.concat_ws("; ", F.transform(pairs, lambda x: x["p"])).alias("summary"))


def event_applies(string_ids: Column, classes: Column, string_id: Column, content: Column) -> Column:
    return F.coalesce(F.array_contains(string_ids, string_id), F.lit(False)) | F.coalesce(F.array_contains(classes, content), F.lit(False))


def row_impacts(rows: DataFrame, delta: DataFrame, key: str, source: str, target: str, module: str) -> DataFrame:
    """Rows that a glossary delta (term, old, new, change) touches: their delta types, class, risk and action.

    A row is touched by a changed term its source holds, or by a changed or removed term whose old target its target holds.
    """
    base = rows.select(key, source, target)
    by_source = contains_join(base, delta.select("term", "change"), source, "term").select(key, "change")
    old = delta.filter("change <> 'added' AND old <> ''").select(F.col("old").alias("_old"), "change")
    by_target = contains_join(base, old, target, "_old").select(key, "change")
    kinds = by_source.union(by_target).groupBy(key).agg(F.array_sort(F.collect_set(F.concat(F.lit("term_"), F.regexp_replace(F.regexp_replace("change", "modified", "changed"), "deleted", "removed")))).alias("delta_types"))
    out = rows.select(key, content_class(F.col(module)).alias("content_class")).join(kinds, key).withColumn("risk", risk_level(F.col("content_class")))
    return out.withColumn("action", recommended_action(F.col("delta_types"), F.col("risk")))
