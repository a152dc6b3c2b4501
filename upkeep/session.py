"""Session construction and the few cluster-wide settings the operators rely on."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, nullcontext

from pyspark.sql import SparkSession

# Settings every job needs regardless of scale.  Shuffle partition counts are
# left to AQE (coalescing) so the same code runs on local[8] and 1000 executors.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "upkeep", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the library assumes."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            # local mode: the driver JVM is the only executor
            builder = builder.config("spark.driver.memory", "16g")
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    # Runtime-settable SQL confs: re-apply in case the session pre-existed.
    for key, value in conf.items():
        if key.startswith("spark.sql."):
            spark.conf.set(key, value)
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Make sure reliable checkpoints have a home.

    The cluster names a shared folder in ``spark.checkpoint.dir``; we always
    use that.  Only a local-mode session (tests, bench) without the setting
    gets a scratch folder of its own, because a machine-local folder is not
    reachable by other executors on a real cluster.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return configured
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder "
            "(HDFS/S3/ABFS) before running on a cluster")
    path = tempfile.mkdtemp(prefix="upkeep-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    return path


def stage_path(spark: SparkSession, name: str | None = None) -> str:
    """A new place for a stored table in the shared checkpoint folder."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/{name or uuid.uuid4().hex}"
    if _SCOPES:
        _SCOPES[-1].append(path)
    return path


# Open scopes of ``temporary_tables``, the innermost last: the places given out inside each.
_SCOPES: list[list[str]] = []


def delete_tables(spark: SparkSession, paths: list[str]) -> None:
    """Deletes stored tables, in whatever store they lie; places never written to are passed over."""
    for path in paths:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


@contextmanager
def temporary_tables(spark: SparkSession) -> Iterator[list[str]]:
    """Deletes at its end, also after an error, the tables that were stored inside it.

    A result that reads them must be written elsewhere (or under a path of
    one's own) before the scope ends.  Tables of an outer scope stay; an inner scope
    deletes its own.  Gives the list of places, from which one may be removed to keep its table.
    """
    paths: list[str] = []
    _SCOPES.append(paths)
    try:
        yield paths
    finally:
        _SCOPES.remove(paths)
        delete_tables(spark, paths)


WIDE = 40   # columns of a table from which on the generated code of one row is split


@contextmanager
def short_methods(spark: SparkSession) -> Iterator[None]:
    """Plans that run inside it evaluate column by column where the generated code of a whole row is longer than the JVM compiles (8,000 bytes)."""
    key = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(key)
    spark.conf.set(key, "8000")
    try:
        yield
    finally:
        spark.conf.set(key, before)


@contextmanager
def released_shuffles(spark: SparkSession) -> Iterator[None]:
    """Writes and other actions that run inside it delete their plan's shuffle files on all executors as they end.

    Without it these files stay until the driver's JVM happens to collect the
    plan, which a long chain of small plans and large tables may never do.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def materialize(df, name: str | None = None, **options: str):
    """Write ``df`` as a Parquet table (zstd) in the shared checkpoint folder and read it back (with ``options`` of the reader).

    Used at stage boundaries that are read more than once (cleaned records,
    feature table): later passes read the stored columns instead of replaying
    joins and shuffles (with column pruning and filter pushdown, which an RDD
    checkpoint cannot give), and a lost executor never replays the lineage.
    What was shuffled to make the table is deleted once it is written.
    """
    spark = df.sparkSession
    path = stage_path(spark, name)
    with released_shuffles(spark), short_methods(spark) if len(df.columns) >= WIDE else nullcontext():
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return spark.read.options(**options).parquet(path)
