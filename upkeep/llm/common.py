"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from upkeep.session import ensure_checkpoint_dir, materialize  # noqa: F401  (materialize is used by the operators)

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

#: Most bytes and rows of one Arrow batch that goes to a Python worker.
BATCH_BYTES, BATCH_ROWS = 16 << 20, 2000

#: Most rows of a side that is broadcast after it was counted; with more rows the join shuffles both sides.
BROADCAST_ROWS = 1_000_000

#: Options of a reader that reads one range after another: vectored reads hold more buffers outside the heap.
PLAIN_READS = {"parquet.hadoop.vectored.io.enabled": "false"}


def prepare(spark: SparkSession) -> None:
    """Session settings for the Python stages: bounded Arrow batches, and workers that find this package."""
    ensure_checkpoint_dir(spark)
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    env = spark.sparkContext.environment
    if REPO not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (REPO, env.get("PYTHONPATH", "")) if x)


def table(spark: SparkSession, sf_dir: str, name: str, **options: str) -> DataFrame:
    """One of the given tables, through Spark's reader with ``options`` (the path may be in any store)."""
    prepare(spark)
    return spark.read.options(**options).parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def small_or_shuffled(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast if a count proves it small; else as it is, so that the join shuffles."""
    return F.broadcast(df) if df.count() <= limit else df


def in_order(df: DataFrame, key: str, content: str) -> DataFrame:
    """``df`` range-partitioned and sorted by ``key`` (nulls first).

    Rows of one key are told apart by a hash of ``content`` and then by their
    place in the input, so that a key with very many rows still splits.
    Columns ``_tie`` and ``_at`` are added.
    """
    keyed = df.withColumn("_tie", F.xxhash64(content)).withColumn("_at", F.monotonically_increasing_id())
    cols = [key, "_tie", "_at"]
    return keyed.repartitionByRange(partitions(df.sparkSession), *cols).sortWithinPartitions(*cols)


def pieces(batches: Iterator[pa.RecordBatch], column: str, piece_bytes: int, block_bytes: int) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Cuts a partition's rows into blocks of about ``block_bytes`` of ``column`` and these into slices of about ``piece_bytes``.

    A block ends with the row that reaches its size; the numbers therefore
    depend on the rows and their order alone, not on how Spark batches them.
    """
    block, in_block = 0, 0
    for batch in batches:
        sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_pylist()
        start, in_piece = 0, 0
        for i, size in enumerate(sizes):
            in_piece += size + 8
            in_block += size + 8
            full = in_block >= block_bytes
            if full or in_piece >= piece_bytes:
                yield block, batch.slice(start, i + 1 - start)
                start, in_piece = i + 1, 0
            if full:
                block, in_block = block + 1, 0
        if start < len(sizes):
            yield block, batch.slice(start)


def texts_of(batch: pa.RecordBatch, column: str) -> list[str]:
    """The column's texts; null counts as empty."""
    return [x or "" for x in batch.column(column).to_pylist()]


WORD = r"[^\x20\x09-\x0D]+"
WORD_BREAK = re.compile(r"[\x20\x09-\x0D]+")
