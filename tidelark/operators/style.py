"""Checks of targets against style and glossary contracts, and what changed between two styles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import strip_spaces, text_or_empty
from .helpers import contains_join


def first_contained(rows: DataFrame, terms: DataFrame, key: str, text: str, term: str, order: str) -> DataFrame:
    """Per row the first entry (by ``order``) that its text contains: blocked terms and prohibited aliases of targets."""
    hits = contains_join(rows.select(key, text), terms.select(term, order), text, term)
    return hits.groupBy(key).agg(F.min_by(term, order).alias(term))


def compact_misses(rows: DataFrame, glossary: DataFrame, key: str, source: str, target: str, category: str, term: str, compact: str, avoid: str, order: str) -> DataFrame:
    """Rows whose source has a term and whose target lacks its compact form, or has one of the long forms to avoid.

    One finding a row and type (the first entry's): a miss in a micro badge is ``compact_mapping_missing`` and major.
    """
    entries = glossary.filter(F.length(compact) > 0).select(F.col(term).alias("__term"), F.col(compact).alias("__compact"), F.col(avoid).alias("__avoid"), F.col(order).alias("__order"))
    hits = contains_join(rows.select(key, source, target, category), entries, source, "__term")
    long = F.exists("__avoid", lambda x: (F.length(x) > 0) & F.contains(F.col(target), x))
    missed = hits.filter(~F.contains(F.col(target), F.col("__compact")) | F.coalesce(long, F.lit(False)))
    first = missed.groupBy(key, category).agg(F.min_by(F.struct("__term", "__compact"), "__order").alias("e"))
    badge = F.col(category).startswith("badge_micro_")
    kind = F.when(badge, "compact_mapping_missing").otherwise("compact_term_miss")
    return first.select(key, kind.alias("type"), F.when(badge, "major").otherwise("minor").alias("severity"), F.col("e.__term").alias("term"), F.col("e.__compact").alias("compact"))


def source_hints(rows: DataFrame, glossary: DataFrame, key: str, source: str, term: str, target: str, order: str, most: int = 5) -> DataFrame:
    """key, hint: the first ``most`` approved terms of the source, each with its target (rows without one have no hint)."""
    hits = contains_join(rows.select(key, source), glossary.filter("status = 'approved'").select(term, target, order), source, term)
    last = hits.groupBy(key, term).agg(F.min(order).alias("__at"), F.max_by(target, order).alias(target))
    pairs = F.slice(F.array_sort(F.collect_list(F.struct("__at", F.concat(term, F.lit("→"), target).alias("p")))), 1, most)
    return last.groupBy(key).agg(F.concat_ws("; ", F.transform(pairs, lambda x: x["p"])).alias("hint"))


def focus_changes(after: DataFrame, before: DataFrame, focus: DataFrame, key: str, source: str, target: str, term: str) -> DataFrame:
    """Every row after a run: whether its target changed, and whether its source (spaces aside) is a focus term."""
    old = before.select(key, F.col(target).alias("__old"))
    terms = focus.select(strip_spaces(F.col(term)).alias("__term")).filter("__term <> ''").distinct().withColumn("__hit", F.lit(True))
    joined = after.join(old, key, "left").withColumn("__key", strip_spaces(F.col(source))).join(terms, F.col("__key") == F.col("__term"), "left")
    changed = text_or_empty(F.col(target)) != text_or_empty(F.col("__old"))
    return joined.select(key, changed.alias("changed"), F.coalesce("__hit", F.lit(False)).alias("focus_hit"))


def focus_rows(rows: DataFrame, focus: DataFrame, source: str, term: str) -> DataFrame:
    """Rows whose source, spaces aside, is a focus term."""
    terms = focus.select(strip_spaces(F.col(term)).alias("__term")).filter("__term <> ''").distinct()
    return rows.withColumn("__key", strip_spaces(F.col(source))).join(terms, F.col("__key") == F.col("__term"), "left_semi").drop("__key")


def split_findings(findings: DataFrame, kind: str, deferred: list[str]) -> DataFrame:
    """Findings with ``track``: deferred for the named types, actionable for the others."""
    return findings.withColumn("track", F.when(F.col(kind).isin(*deferred), "deferred").otherwise("actionable"))


def preferred_changes(old: DataFrame, new: DataFrame, term: str, target: str) -> DataFrame:
    """term, old_target, new_target of every term whose preferred target differs (missing: empty)."""
    joined = old.select(term, F.col(target).alias("old_target")).join(new.select(term, F.col(target).alias("new_target")), term, "full")
    return joined.filter(~F.col("old_target").eqNullSafe(F.col("new_target"))).select(term, text_or_empty(F.col("old_target")).alias("old_target"), text_or_empty(F.col("new_target")).alias("new_target"))


def newly_listed(old: DataFrame, new: DataFrame, column: str) -> DataFrame:
    """Distinct entries of a list (banned terms, aliases) that the old one lacks."""
    return new.select(column).distinct().join(old.select(column).distinct(), column, "left_anti")


def distinct_issues(issues: DataFrame, order: str, context: str = "context", keys: tuple[str, ...] = ("run_id", "stage", "error_code", "row", "string_id")) -> DataFrame:
    """The last issue of each key, nested contexts compared as JSON with sorted keys."""
    canonical = F.to_json(F.map_from_entries(F.array_sort(F.map_entries(context)))) if issues.schema[context].dataType.typeName() == "map" else F.col(context)
    keyed = issues.withColumn("__context", F.coalesce(canonical, F.lit("{}")))
    row = F.struct(*issues.columns)
    return keyed.groupBy(*keys, "__context").agg(F.max_by(row, order).alias("__row")).select("__row.*")


def profile_issues(profiles: DataFrame, key: str, present: Column, source_language: Column, target_language: Column, length_constraints: Column) -> DataFrame:
    """Rules D-TL-001 and D-TL-002 on style profiles, a row a breach: a missing one has no other."""
    lacks = lambda x: F.coalesce(F.trim(x.cast("string")), F.lit("")) == ""
    there = F.coalesce(present, F.lit(False))
    codes = F.array_compact(F.array(
        F.when(~there, F.struct(F.lit("D-TL-001").alias("rule_id"), F.lit("profile").alias("part"))),
        F.when(there & (lacks(source_language) | lacks(target_language)), F.struct(F.lit("D-TL-002").alias("rule_id"), F.lit("project").alias("part"))),
        F.when(there & lacks(length_constraints), F.struct(F.lit("D-TL-002").alias("rule_id"), F.lit("ui").alias("part"))),
    ))
    return profiles.select(key, F.explode(codes).alias("b")).select(key, "b.rule_id", "b.part", F.lit("major").alias("severity"))


def banned_in_glossary(banned: DataFrame, approved: DataFrame, word: str, target: str) -> DataFrame:
    """Rule D-TL-003: banned words that are targets of approved entries."""
    return banned.select(F.lower(F.trim(word)).alias(word)).distinct().join(approved.select(F.lower(F.trim(target)).alias(word)).distinct(), word, "left_semi")


def long_and_short_sample(rows: DataFrame, key: str, text: str, long_n: int = 80, other_n: int = 20, threshold: int = 300, fallback: int = 200, seed: int = 42) -> DataFrame:
    """``long_n`` rows longer than the threshold (the fallback, if there are too few) and ``other_n`` of the others.

    Rows are taken in the order of md5(key + seed): a library's random stream has no place in a distributed plan.
    """
    order = F.md5(F.concat(F.col(key).cast("string"), F.lit(str(seed))).cast("binary"))
    sized = rows.withColumn("__n", F.length(text))
    enough = (sized.agg(F.count_if(F.col("__n") > threshold)).first()[0] or 0) >= long_n
    long = sized.filter(F.col("__n") > (threshold if enough else fallback)).orderBy(order, key).limit(long_n).withColumn("bucket", F.lit("long"))
    rest = sized.join(F.broadcast(long.select(key)), key, "left_anti").orderBy(order, key).limit(other_n).withColumn("bucket", F.lit("other"))
    return long.unionByName(rest).drop("__n")
