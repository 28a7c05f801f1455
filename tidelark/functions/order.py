"""Running numbers without a single-task sort: ranges of the order, numbered side by side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Of a monotonically increasing id: the rows of a partition come after the partition's number.
_ROW_BITS = 33


def numbered(df: DataFrame, order: Sequence[str | Column], name: str = "number") -> DataFrame:
    """``df`` with each row's place, from 1, in a total order (equal rows of the order may take each other's place).

    Rows are dealt by ranges of the order and sorted within them, which is written once; a number is the place within
    its range plus the sizes of the ranges before (a row a partition on the driver).
    """
    from ..streaming.state import shared_checkpoint

    runs = shared_checkpoint(df.repartitionByRange(*order).sortWithinPartitions(*order))
    counts = {r[0]: r[1] for r in runs.groupBy(F.spark_partition_id().alias("p")).count().collect()}
    before, at = [], 1
    for p in sorted(counts):
        before += [F.lit(p), F.lit(at)]
        at += counts[p]
    offset = F.element_at(F.create_map(*before), F.spark_partition_id()) if before else F.lit(1)
    within = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return runs.withColumn(name, within + offset)


def numbered_within(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], name: str = "number") -> DataFrame:
    """``df`` with each row's place, from 1, among the rows of its keys; one key may hold most rows."""
    whole = numbered(df, [*keys, *order], "__at")
    first = whole.groupBy(*[F.col(k).alias(f"__{k}") for k in keys]).agg(F.min("__at").alias("__first"))
    same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    on = same[0]
    for s in same[1:]:
        on = on & s
    return whole.join(first, on).withColumn(name, F.col("__at") - F.col("__first") + 1).drop("__at", "__first", *[f"__{k}" for k in keys])
