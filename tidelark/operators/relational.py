"""Joins, set operations, ordered and sampling operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.estimate import hash_order
from ..functions.order import numbered, numbered_within
from .helpers import contains_join, keep_first


def missing_keys(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left keys without a match: the rows an assertion of coverage reports."""
    return left.join(right.select(key).distinct(), key, "left_anti")


def inner_checked(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Inner join that fails, when it runs, on a left row without a match."""
    hit = F.lit(True)
    out = left.join(right.withColumn("_hit", hit), key, "left")
    return out.filter(F.when(F.col("_hit"), True).otherwise(F.raise_error(F.concat(F.lit(f"no match for {key} "), F.coalesce(F.col(key).cast("string"), F.lit("null")))).cast("boolean"))).drop("_hit")


def override_join(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Matched rows; where both have a column, the right one's stands."""
    return left.drop(*[c for c in right.columns if c != key]).join(right, key)


def restore_delivery(prepared: DataFrame, translated: DataFrame, key: str, empty: Column, done: Column) -> DataFrame:
    out = prepared.join(translated, key, "left")
    return out.withColumn("delivery_status", F.when(empty, "skipped_empty").when(done, "translated").otherwise("missing_translation"))


def overlay(base: DataFrame, patch: DataFrame, key: str, forced: Sequence[str] = ()) -> DataFrame:
    """Base rows with the patch's non-empty values; ``forced`` columns win even if empty."""
    shared = [c for c in patch.columns if c != key and c in base.columns]
    p = patch.select(key, F.lit(True).alias("_hit"), *[F.col(c).alias(f"_p_{c}") for c in shared])
    out = base.join(p, key, "left")
    take = lambda c: F.col("_hit") if c in forced else F.coalesce(F.col(f"_p_{c}").cast("string"), F.lit("")) != ""
    return out.withColumns({c: F.when(take(c), F.col(f"_p_{c}")).otherwise(F.col(c)) for c in shared}).select(*base.columns)


def diff(before: DataFrame, after: DataFrame, key: str, value: str) -> DataFrame:
    """Full outer difference: key, before, after, change (added, deleted, modified)."""
    a, b = before.select(key, F.col(value).alias("before"), F.lit(1).alias("_a")), after.select(key, F.col(value).alias("after"), F.lit(1).alias("_b"))
    out = a.join(b, key, "full_outer").filter(~F.col("before").eqNullSafe(F.col("after")) | F.col("_a").isNull() | F.col("_b").isNull())
    change = F.when(F.col("_a").isNull(), "added").when(F.col("_b").isNull(), "deleted").otherwise("modified")
    return out.select(key, "before", "after", change.alias("change"))


def changed_pairs(before: DataFrame, after: DataFrame, key: str, value: str, same: Column | None = None) -> DataFrame:
    """Rows whose value changed, blank on neither side, and (optionally) alike by ``same`` over before and after."""
    out = diff(before, after, key, value).filter("change = 'modified' AND trim(before) <> '' AND trim(after) <> ''")
    return out if same is None else out.filter(same)


def hydrate(rows: DataFrame, lookup: DataFrame, key: str, column: str) -> DataFrame:
    """Blanks filled from a lookup of one row a key."""
    side = lookup.select(key, F.col(column).alias("_v"))
    return rows.join(side, key, "left").withColumn(column, F.coalesce(F.when(F.col(column) == "", None).otherwise(F.col(column)), F.col("_v"))).select(*rows.columns)


def pending(rows: DataFrame, done: DataFrame, key: str) -> DataFrame:
    return rows.join(done.select(key).distinct(), key, "left_anti")


def fill_missing(have: DataFrame, all_rows: DataFrame, key: str) -> DataFrame:
    return have.unionByName(pending(all_rows, have, key), allowMissingColumns=True)


def new_findings(candidate: DataFrame, baseline: DataFrame, keys: Sequence[str]) -> DataFrame:
    return candidate.select(*keys).subtract(baseline.select(*keys))


def without_conflict(rows: DataFrame, approved: DataFrame, term: str, target: str) -> DataFrame:
    """Rows whose term has no other approved target."""
    a = approved.select(F.col(term).alias("_t"), F.col(target).alias("_o")).distinct()
    return rows.join(a, (F.col(term) == F.col("_t")) & (F.col(target) != F.col("_o")), "left_anti")


def first_violation(rows: DataFrame, glossary: DataFrame, key: str, source: str, target: str, term: str, wanted: str, order: str) -> DataFrame:
    """Per row the first glossary entry whose term the source has and whose wanted form the target lacks."""
    hit = contains_join(rows.select(key, source, F.col(target).alias("_target")), glossary.select(term, F.col(wanted).alias("_wanted"), order), source, term)
    return hit.filter(~F.contains("_target", F.col("_wanted"))).groupBy(key).agg(F.min_by(term, order).alias(term))


def id_union(*frames: DataFrame) -> DataFrame:
    return reduce(DataFrame.union, frames).distinct()


def priced(rows: DataFrame, rates: DataFrame, key: str, default: float) -> DataFrame:
    """Rates joined by name, a default where there is none."""
    return rows.join(rates, key, "left").withColumn("rate", F.coalesce("rate", F.lit(default)))


def fuzzy_priced(names: DataFrame, rates: DataFrame, key: str) -> DataFrame:
    """Distinct names with the rate of an equal name, else of the longest that contains or is contained."""
    r = rates.select(F.col(key).alias("_name"), "rate")
    n = names.select(key).distinct()
    near = F.contains(key, F.col("_name")) | F.contains("_name", F.col(key))
    best = F.max_by("rate", F.struct((F.col(key) == F.col("_name")).alias("e"), F.length("_name").alias("n"), F.col("_name")))
    return n.join(r, near, "left").groupBy(key).agg(best.alias("rate"))


def share_of_max(df: DataFrame, column: str) -> DataFrame:
    """``column`` over its maximum; the maximum is an aggregate of one row, broadcast back."""
    top = df.agg(F.max(column).alias("_top"))
    return df.join(F.broadcast(top)).withColumn("share", F.col(column) / F.col("_top")).drop("_top")


def running(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, ts: str) -> DataFrame:
    """Running total and the time since the row before, per key."""
    w = Window.partitionBy(*keys).orderBy(*order)
    total = F.sum(value).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return df.withColumns({"done": total, "gap_us": F.unix_micros(F.col(ts)) - F.unix_micros(F.lag(ts).over(w))})


def most_common(df: DataFrame, column: str, seq: str, k: int) -> DataFrame:
    """The k most frequent values, ties by first occurrence."""
    return df.groupBy(column).agg(F.count("*").alias("n"), F.min(seq).alias("_at")).orderBy(F.desc("n"), "_at").limit(k).drop("_at")


def churn(base: DataFrame, now: DataFrame, key: str) -> DataFrame:
    """One row: added, removed, common, churn (all against the base's size; 1 if it is empty)."""
    a, b = base.select(F.col(key).alias("_a")).distinct(), now.select(F.col(key).alias("_b")).distinct()
    j = a.join(b, F.col("_a") == F.col("_b"), "full_outer")
    n = lambda x: F.count_if(x)
    out = j.agg(n(F.col("_a").isNull()).alias("added"), n(F.col("_b").isNull()).alias("removed"), n(F.col("_a").isNotNull() & F.col("_b").isNotNull()).alias("common"))
    size = F.col("removed") + F.col("common")
    return out.withColumn("churn", F.when(size == 0, 1.0).otherwise((F.col("added") + F.col("removed")) / size))


def coverage(expected: Column, returned: Column) -> Column:
    return F.struct(F.array_except(expected, returned).alias("missing"), F.array_except(returned, expected).alias("extra"))


def merge_shards(shards: Sequence[DataFrame], key: str) -> DataFrame:
    """Union by name, the earlier shard's row of a key first."""
    tagged = [s.withColumn("_shard", F.lit(i)) for i, s in enumerate(shards)]
    return keep_first(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged), [key], "_shard").drop("_shard")


def largest_remainder(counts: Mapping[str, int], total: int) -> dict[str, int]:
    """Integer quotas in proportion, the rest by largest remainder, then size, then name; none above its count."""
    whole = sum(counts.values())
    if not whole:
        return {}
    raw = {k: total * n / whole for k, n in counts.items()}
    out = {k: int(v) for k, v in raw.items()}
    order = sorted(counts, key=lambda k: (-(raw[k] - out[k]), -counts[k], k))
    left = min(total, whole) - sum(out.values())
    while left > 0:
        for k in order:
            if left and out[k] < counts[k]:
                out[k] += 1
                left -= 1
    return out


def quota_filter(df: DataFrame, group: str, key: str, quotas: Mapping[str, int], seed: int) -> DataFrame:
    w = Window.partitionBy(group).orderBy(hash_order(F.col(key), seed), key)
    limits = F.create_map(*[F.lit(x) for kv in quotas.items() for x in kv]) if quotas else F.create_map()
    return df.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") <= F.coalesce(F.try_element_at(limits, F.col(group)), F.lit(0)))


def stratified_sample(df: DataFrame, group: str, key: str, total: int, seed: int) -> DataFrame:
    """Largest-remainder quotas (a row a stratum on the driver), hash order within strata."""
    counts = {r[group]: r["count"] for r in df.groupBy(group).count().collect()}
    return quota_filter(df, group, key, largest_remainder(counts, total), seed).drop("_rank")


def quota_sample(df: DataFrame, group: str, key: str, quotas: Mapping[str, int], total: int, seed: int) -> DataFrame:
    """Quotas per group; a shortfall of the total is filled round-robin by rank from the groups' next rows."""
    w = Window.partitionBy(group).orderBy(hash_order(F.col(key), seed), key)
    limits = F.create_map(*[F.lit(x) for kv in quotas.items() for x in kv])
    ranked = df.withColumn("_rank", F.row_number().over(w)).withColumn("_over", F.greatest(F.col("_rank") - F.coalesce(F.try_element_at(limits, F.col(group)), F.lit(0)), F.lit(0)))
    return ranked.orderBy("_over", F.when(F.col("_over") == 0, 0).otherwise(1), group, "_rank").limit(total).drop("_rank", "_over")


def bucketed_sample(df: DataFrame, key: str, buckets: Sequence[tuple[str, Column, int]], order: Sequence[Column]) -> DataFrame:
    """Ordered buckets without replacement: top rows of each among those no earlier bucket took.

    A loop over the (few) buckets; each takes a bounded number of rows.
    """
    taken: DataFrame | None = None
    for name, condition, n in buckets:
        rest = df.filter(condition) if taken is None else df.filter(condition).join(F.broadcast(taken.select(key)), key, "left_anti")  # bounded by the quotas
        part = rest.orderBy(*order).limit(n).select(F.lit(name).alias("bucket"), *df.columns)
        taken = part if taken is None else taken.union(part)
    return taken


def padded_sample(df: DataFrame, key: str, n: int, prefix: str) -> DataFrame:
    """n rows by hash order, the shortfall filled with made-up ids."""
    some = df.orderBy(hash_order(F.col(key)), key).limit(n).select(F.col(key).cast("string").alias("id"))
    have = some.agg(F.count("*").alias("_have"))
    pad = df.sparkSession.range(n).join(F.broadcast(have)).filter("id >= _have").select(F.concat(F.lit(prefix), F.col("id").cast("string")).alias("id"))
    return some.union(pad)


def mixed_batches(df: DataFrame, key: str, empty: Column, full_size: int, empty_size: int) -> DataFrame:
    """Batches of ``full_size`` full and ``empty_size`` empty rows by hash order."""
    order = F.sha2(F.col(key).cast("string").cast("binary"), 256)
    size = F.when(F.col("_empty"), empty_size).otherwise(full_size)
    placed = numbered_within(df.withColumns({"_empty": empty, "_order": order}), ["_empty"], ["_order", key], "_n")
    return placed.withColumn("batch", F.floor((F.col("_n") - 1) / size)).drop("_empty", "_order", "_n")


def modulo_shard(df: DataFrame, order: str, total: int, shard: int) -> DataFrame:
    """Rows i of an order with i % total = shard."""
    return numbered(df, [order], "_i").filter((F.col("_i") - 1) % total == shard).drop("_i")
