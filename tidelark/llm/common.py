"""Shared plumbing of the corpus operators: tables, Arrow maps, shared checkpoints."""

from __future__ import annotations

import contextlib
import ctypes
import tempfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of one Arrow slice handed to a kernel; bounds the memory of a worker on long texts.
SLICE_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage through the folder named by ``spark.checkpoint.dir``.

    A folder of this machine is set only where the session names none and runs on this machine alone (tests).
    """
    spark = df.sparkSession
    if not spark.conf.get("spark.checkpoint.dir", None) and spark.sparkContext.getCheckpointDir() is None:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tidelark-"))
    return df.checkpoint(eager=True)


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that the strings of ``column`` stay near ``limit`` bytes each."""
    for batch in batches:
        n, size = batch.num_rows, batch.column(column).nbytes if batch.num_rows else 0
        step = max(1, n * limit // max(size, 1)) if size > limit else max(n, 1)
        for at in range(0, n, step):
            yield batch.slice(at, step)


#: Rows and bytes of an Arrow batch, where the session has Spark's own defaults: texts are long rows.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2000", "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20)}


def bounded(df: DataFrame) -> DataFrame:
    """``df``, with Arrow batches of bounded memory in its session unless the session has set its own."""
    conf = df.sparkSession.conf
    for key, value in BATCH.items():
        if conf.get(key, None) is None:  # Spark's default holds
            conf.set(key, value)
    return df


def release() -> None:
    """Give freed memory back to the system: workers stay, and what one slice or group needed would stay with them."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # another C library
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def map_text(df: DataFrame, kernel: Callable[[pa.RecordBatch], pa.RecordBatch | dict], schema: str) -> DataFrame:
    """Apply ``kernel`` to bounded Arrow slices; it returns a dict of columns in the order of ``schema``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            out = kernel(part)
            yield out if isinstance(out, pa.RecordBatch) else pa.RecordBatch.from_pydict(out)
            del part, out
            release()

    return bounded(df).mapInArrow(run, schema)


def crc_mod(column: str, n: int) -> F.Column:
    """crc32 of the id as text, modulo ``n`` (a null id counts as the empty text)."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % n


def utf8_len(column: str = "text") -> F.Column:
    return F.coalesce(F.octet_length(F.col(column)), F.lit(0)).cast("long")
