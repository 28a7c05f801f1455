"""Relational building blocks: first, last and top rows of groups, multiset differences, as-of and containment joins, packing.

Every order takes an explicit tie-break; none relies on the order of rows in a DataFrame.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.order import numbered_within

#: Largest dictionary (bytes, by a count of its terms' letters) that a containment join broadcasts.
BROADCAST_BYTES = 32 << 20


def pick_column(df: DataFrame, candidates: Sequence[str]) -> str | None:
    """The first candidate that is a column (by its existence, not its values)."""
    return next((c for c in candidates if c in df.columns), None)


def top_n(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1) -> DataFrame:
    return df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("_rank") <= n).drop("_rank")


def keep_first(df: DataFrame, keys: Sequence[str], seq: str) -> DataFrame:
    """One row per key, the first by ``seq``: an aggregate, so that repeats shrink before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    best = F.min_by(F.struct(*rest), F.col(seq)).alias("_row")
    return df.groupBy(*keys).agg(best).select(*keys, "_row.*").select(*df.columns)


def keep_last(df: DataFrame, keys: Sequence[str], seq: str) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    best = F.max_by(F.struct(*rest), F.col(seq)).alias("_row")
    return df.groupBy(*keys).agg(best).select(*keys, "_row.*").select(*df.columns)


def number_repeats(df: DataFrame, key: str, seq: str, suffix: str = "_dup") -> DataFrame:
    """Repeated keys become key, key_dup1, key_dup2 ... in order."""
    n = F.row_number().over(Window.partitionBy(key).orderBy(seq)) - 1
    return df.withColumn(key, F.when(n > 0, F.concat(F.col(key).cast("string"), F.lit(suffix), n.cast("string"))).otherwise(F.col(key).cast("string")))


def multiset_diff(a: Column, b: Column) -> Column:
    """Map of the elements of array ``a`` beyond their count in ``b``, with the surplus."""
    count = lambda xs, x: F.size(F.filter(xs, lambda y: y == x))
    pairs = F.transform(F.array_distinct(a), lambda x: F.struct(x.alias("key"), (count(a, x) - count(b, x)).alias("value")))
    return F.map_from_entries(F.filter(pairs, lambda p: p["value"] > 0))


def asof_backward(left: DataFrame, right: DataFrame, keys: Sequence[str], left_ts: str, right_ts: str, value: Column, tolerance: Column, name: str = "matched") -> DataFrame:
    """Each left row with ``value`` of the latest right row at or before it, within ``tolerance`` seconds (may use left columns).

    One union and one ordered window per key: no pairs are made.  The right rows' columns must not clash with the left's.
    """
    a = left.select(*keys, F.col(left_ts).alias("_ts"), F.lit(1).alias("_side"), F.struct(*left.columns).alias("_row"), F.lit(None).cast(right.select(value).schema[0].dataType).alias("_value"), F.lit(None).cast("timestamp").alias("_vts"))
    b = right.select(*keys, F.col(right_ts).alias("_ts"), F.lit(0).alias("_side"), F.lit(None).cast(a.schema["_row"].dataType).alias("_row"), value.alias("_value"), F.col(right_ts).alias("_vts"))
    w = Window.partitionBy(*keys).orderBy("_ts", "_side").rowsBetween(Window.unboundedPreceding, 0)
    seen = F.last(F.when(F.col("_side") == 0, F.struct("_value", "_vts")), ignorenulls=True).over(w)
    both = a.unionByName(b).withColumn("_seen", seen).filter("_side = 1").select("_row.*", "_seen")
    near = F.col("_seen._vts").isNotNull() & ((F.col(left_ts).cast("double") - F.col("_seen._vts").cast("double")) <= tolerance)
    return both.withColumn(name, F.when(near, F.col("_seen._value"))).drop("_seen")


def contains_join(rows: DataFrame, terms: DataFrame, text: str, term: str, how: str = "inner") -> DataFrame:
    """Rows with every term that their text contains.  Null and empty terms are in no text, whatever the dictionary's size.

    The dictionary is broadcast while it is small by measure; beyond that, rows are matched by the terms' first
    letters: an equi-join on runs of the shortest term's length, then the containment test.
    """
    terms = terms.filter(F.length(term) > 0)
    size = terms.select(F.sum(F.octet_length(term) + 64)).first()[0] or 0
    hit = F.contains(F.col(text), F.col(term))
    if size <= BROADCAST_BYTES:
        return rows.join(F.broadcast(terms), hit, how)
    k = terms.select(F.min(F.length(term))).first()[0]
    grams = F.explode(F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.length(text) - k + 1, F.lit(1))), lambda i: F.substring(F.col(text), i, F.lit(k)))))
    keyed = rows.withColumn("__gram", grams)
    matched = keyed.join(terms.withColumn("__head", F.substring(F.col(term), 1, k)), (F.col("__gram") == F.col("__head")) & hit).drop("__gram", "__head")
    if how == "inner":
        return matched
    missing = rows.join(matched.select(*rows.columns), [rows[c].eqNullSafe(matched[c]) for c in rows.columns], "left_anti")
    return matched.unionByName(missing, allowMissingColumns=True)


def ordered_pack(df: DataFrame, key: str, seq: str, tokens: str, max_items: int, max_tokens: int) -> DataFrame:
    """Batch numbers by an ordered fold: a batch closes at ``max_items`` rows or before it would pass ``max_tokens``.

    The fold is sequential within a key; deal large inputs to keys (shards) first.
    """

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(seq, kind="stable")
        batch, items, used, out = 0, 0, 0, []
        for t in pdf[tokens]:
            if items and (items >= max_items or used + t > max_tokens):
                batch, items, used = batch + 1, 0, 0
            items, used = items + 1, used + t
            out.append(batch)
        return pdf.assign(batch=out)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields) + ", batch int"
    return df.groupBy(key).applyInPandas(fold, schema)


def fixed_batches(df: DataFrame, keys: Sequence[str], seq: str, n: int) -> DataFrame:
    return numbered_within(df, list(keys), [seq], "_n").withColumn("batch", F.floor((F.col("_n") - 1) / n).cast("int")).drop("_n")
