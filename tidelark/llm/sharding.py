"""Hilbert-curve sharding: quantise metadata dimensions, sort by curve index, cut equal runs.

Rows that are near in every dimension are near on the curve, so each shard covers a compact box of the metadata
space and a reader can prune shards by any of the dimensions.  The law is ``rows``: shard counts differ by one at most.

Numbers are quantised on a logarithmic scale, strings by a checksum cell (equal strings share a cell); both are rules
of the value alone, so a row's index does not depend on the other rows.  Ties on the curve are ordered by text
checksum (equal texts stay together) and id; equal rows may take each other's place.

Defined results: null text has size 1 and checksum 0; a null dimension takes cell 0; repeated rows keep their own
slots; an empty table gives an empty result; columns other than the dimensions are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, utf8_len


def hilbert_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Index on the Hilbert curve of each row of ``cells`` (n x d, values under 2**bits), d * bits <= 62.

    The coordinates are turned into the curve's transposed form by undoing, from the highest bit down, the exchanges
    and inversions of each sub-cube, then Gray-decoded and interleaved.
    """
    x = cells.astype(np.int64).T.copy()
    d = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for i in range(d):
            on = (x[i] & q) != 0
            swap = np.where(on, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(on, low, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, d):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        turn ^= np.where(x[d - 1] & q, q - 1, 0)
        q >>= 1
    x ^= turn
    out = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(d):
            out = out << 1 | (x[i] >> b & 1)
    return out


def cell(df: DataFrame, column: str, bits: int) -> F.Column:
    """The quantised value of one dimension."""
    top = (1 << bits) - 1
    kind = dict(df.dtypes)[column]
    if kind in ("string", "binary", "boolean", "date", "timestamp"):
        return F.coalesce(F.crc32(df[column].cast("string").cast("binary")) % top + 1, F.lit(0)).cast("int")
    value = F.greatest(df[column].cast("double"), F.lit(0.0))
    steps = max(1, top // 48)
    placed = F.least(F.lit(top), F.floor(F.log2(value + 1) * steps) + 1)
    return F.when(df[column].isNull(), 0).otherwise(placed).cast("int")  # the greatest of a null and 0 is 0


def hilbert_shards(docs: DataFrame, n_shards: int = 8, dims: tuple[str, ...] = ("lang", "source", "n_chars"), bits: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, size, text_crc32, law, shard, slot, grown_shard (null), curve (the index that was sorted)."""

    @F.pandas_udf("long")
    def curve(*columns: pd.Series) -> pd.Series:
        return pd.Series(hilbert_index(np.column_stack([c.to_numpy() for c in columns]), bits))

    keyed = docs.select(
        docs[id_col].alias("id"),
        (utf8_len(text_col) + 1).alias("size"),
        F.coalesce(F.crc32(docs[text_col].cast("binary")), F.lit(0)).cast("long").alias("crc"),
        curve(*(cell(docs, c, bits) for c in dims)).alias("curve"),
    )
    order = ["curve", "crc", "id"]
    # the sorted runs are written once, so that the counts and the numbering see the same partitions
    runs = checkpointed(keyed.repartitionByRange(*order).sortWithinPartitions(*order))
    counts = {r[0]: r[1] for r in runs.groupBy(F.spark_partition_id().alias("p")).count().collect()}  # a row a partition
    total, start, first = sum(counts.values()), 0, {}
    for p in sorted(counts):
        first[p] = start
        start += counts[p]

    def number(batches):
        at = first.get(TaskContext.get().partitionId(), 0)
        for b in batches:
            seq = np.arange(at, at + b.num_rows, dtype=np.int64)
            at += b.num_rows
            shard = seq * n_shards // max(total, 1)
            slot = seq - -(-shard * total // n_shards)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), b.column(2), pa.array(["rows"] * b.num_rows, pa.string()), pa.array(shard.astype(np.int32)), pa.array(slot), pa.nulls(b.num_rows, pa.int32()), b.column(3)],
                names=[id_col, "size", "text_crc32", "law", "shard", "slot", "grown_shard", "curve"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return runs.mapInArrow(number, f"{id_col} {kind}, size long, text_crc32 long, law string, shard int, slot long, grown_shard int, curve long")
