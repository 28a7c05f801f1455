"""Vector similarity by higher-order functions (inside code generation, no Python)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """0 where a norm is 0."""
    n = norm(a) * norm(b)
    return F.when(n > 0, dot(a, b) / n).otherwise(0.0)


def retrieve(corpus: DataFrame, queries: DataFrame, key: str, vector: str, query: str, k: int = 15, above: float = 0.3) -> DataFrame:
    """The k rows most like any of a few queries (one text's), then those above the threshold: limit before threshold."""
    few = queries.agg(F.collect_list(query).alias("_qs"))  # the queries of one text: a handful
    best = F.array_max(F.transform("_qs", lambda q: cosine(F.col(vector), q)))
    top = corpus.join(F.broadcast(few)).select(key, best.alias("similarity")).orderBy(F.desc("similarity"), key).limit(k)
    return top.filter(F.col("similarity") > above)


def cache_key(text: Column, model: str) -> Column:
    return F.md5(F.concat(text, F.lit(f"_{model}")).cast("binary"))


def cached_embeddings(texts: DataFrame, cache: DataFrame, text: str, model: str, embed: Column, width: int) -> DataFrame:
    """text, vector: blanks are zeros, known texts come from the cache, only the others meet the embedder."""
    keyed = texts.select(text).distinct().withColumn("_key", cache_key(F.col(text), model))
    blank = F.trim(text) == ""
    have = keyed.join(cache.select(F.col("key").alias("_key"), "vector"), "_key", "left")
    zero = F.array_repeat(F.lit(0.0), width)
    known = have.filter(blank | F.col("vector").isNotNull()).select(text, F.when(blank, zero).otherwise(F.col("vector")).alias("vector"))
    new = have.filter(~blank & F.col("vector").isNull()).select(text, embed.alias("vector"))
    return known.unionByName(new)
