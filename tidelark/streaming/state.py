"""Structured Streaming over append-only logs, and the shared checkpoint folder.

The windows and sessions are extensions: the batch operators read the same logs whole.
"""

from __future__ import annotations

import tempfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder that the session names for checkpoints; one of this machine's own only where all runs on this machine."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="tidelark-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def shared_checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage in the folder that the session names."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def read_log(spark: SparkSession, path: str, schema: str, fmt: str = "json") -> DataFrame:
    return spark.readStream.schema(schema).format(fmt).load(path)


def running_metrics(events: DataFrame, *keys: str) -> DataFrame:
    """Counts per key for complete or update mode."""
    return events.groupBy(*keys).agg(F.count("*").alias("n"))


def tumbling(events: DataFrame, ts: str, every: str, late: str, *keys: str) -> DataFrame:
    return events.withWatermark(ts, late).groupBy(F.window(ts, every), *keys).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), *keys, "n")


def sliding(events: DataFrame, ts: str, size: str, slide: str, late: str, *keys: str) -> DataFrame:
    return events.withWatermark(ts, late).groupBy(F.window(ts, size, slide), *keys).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), *keys, "n")


def sessions(events: DataFrame, ts: str, gap: str, late: str, *keys: str) -> DataFrame:
    out = events.withWatermark(ts, late).groupBy(F.session_window(ts, gap).alias("window"), *keys).agg(F.count("*").alias("n"))
    return out.select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), *keys, "n")


def run_available(df: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Process what is there and stop."""
    df.writeStream.format("parquet").outputMode(mode).option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def resume(rows: DataFrame, done_path: str, work: Callable[[DataFrame], DataFrame], key: str, checkpoint: str) -> None:
    """Each micro-batch works on rows not done before and appends them: a restart does none twice."""

    def each(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        try:
            done = spark.read.parquet(done_path).select(key)
        except Exception as e:  # noqa: BLE001 - the first batch finds no folder
            if "PATH_NOT_FOUND" not in str(e):
                raise
            done = None
        todo = batch if done is None else batch.join(done.distinct(), key, "left_anti")
        work(todo.dropDuplicates([key])).write.mode("append").parquet(done_path)

    rows.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def stale_steps(progress: DataFrame, step: str, ts: str, now: F.Column, after_s: int = 300) -> DataFrame:
    """Steps whose last sign of life is older than ``after_s`` seconds."""
    last = progress.groupBy(step).agg(F.max(ts).alias("last_seen"))
    return last.withColumn("stale", now.cast("timestamp").cast("double") - F.col("last_seen").cast("timestamp").cast("double") > after_s)


def numbered_feedback(have: DataFrame, new: DataFrame, order: str) -> DataFrame:
    """New entries with ids that go on from those there are."""
    from ..functions.order import numbered

    top = have.agg(F.coalesce(F.max("entry_id"), F.lit(0)).alias("_top"))
    return numbered(new, [order], "_n").join(F.broadcast(top)).withColumn("entry_id", F.col("_top") + F.col("_n")).drop("_n", "_top")
