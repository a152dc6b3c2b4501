"""Incremental ingestion of landed export files with Structured Streaming.

Export files (the REST export, re-aimed as files dropped into a landing
folder) are picked up as they arrive.  Per-record rules that need no
history run on the stream (essentials, types, business rules with nulls
passing), and every row that passes is appended to a Parquet table that the
batch chain reads.  Exports may arrive late and in any order, so the stream keeps
no watermark and drops no row for its date: duplicate keys, the date
range, group-level fills and features belong to the batch chain, where
whole histories are available.  ``start_exact_ingest`` removes duplicate keys too: micro-batches are
added as versions, which are merged on reading and, once they are many and
long beside the merged part, in the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from upkeep import schema as S
from upkeep.operators.quality import (coerce_types, drop_duplicates_first, drop_invalid_types, drop_missing_essentials,
                                      drop_rule_violations, ensure_required_columns)
from upkeep.session import ensure_checkpoint_dir


def landed_records(spark: SparkSession, landing: str, max_files_per_trigger: int = 100) -> DataFrame:
    """Streaming DataFrame of canonical records from JSON Lines export files."""
    raw = (spark.readStream.schema(S.RAW_RECORD_SCHEMA)
           .option("maxFilesPerTrigger", max_files_per_trigger).json(landing))
    return coerce_types(raw)


def validate_stream(df: DataFrame) -> DataFrame:
    """Record-level rules; stateless, so no row depends on when another arrived."""
    df = drop_invalid_types(drop_missing_essentials(ensure_required_columns(df)))
    return drop_rule_violations(df)


def start_ingest(spark: SparkSession, landing: str, table_path: str, checkpoint: str | None = None,
                 available_now: bool = True):
    """Append validated records to ``table_path``; returns the StreamingQuery.

    The progress checkpoint lives under the cluster's shared checkpoint
    folder unless one is given, so a restarted driver resumes exactly.
    """
    import hashlib

    base = ensure_checkpoint_dir(spark).rstrip("/")
    # stable across driver restarts, so a restarted query resumes from its offsets
    checkpoint = checkpoint or f"{base}/ingest-{hashlib.sha1(table_path.encode()).hexdigest()[:16]}"
    stream = validate_stream(landed_records(spark, landing))
    writer = (stream.writeStream.format("parquet").option("path", table_path)
              .option("checkpointLocation", checkpoint).outputMode("append"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


# ------------------------------------------------------------ exact ingest
BUCKETS = 64
#: Versions are merged once there are so many and they hold so many times the rows of the last merge: every row is then
#: merged a bounded number of times on average, however many batches there are.
MERGE_VERSIONS, MERGE_GROWTH = 16, 4


def _stored(spark: SparkSession, *paths: str, base: str | None = None) -> DataFrame | None:
    from pyspark.errors import AnalysisException

    try:
        return (spark.read.option("basePath", base) if base else spark.read).parquet(*paths)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in (error.getCondition() or "") or "UNABLE_TO_INFER_SCHEMA" in (error.getCondition() or ""):
            return None
        raise


def _listed(spark: SparkSession, table_path: str, before: int | None = None) -> list:
    """(version, rows, merged) of the finished batches (below ``before``) that make up the table: the last merge, if any, and what came after it."""
    done = _stored(spark, f"{table_path}/done")
    if done is None:
        return []
    if before is not None:
        done = done.where(F.col("version") < before)
    last = done.where("merged").agg(F.max("version")).first()[0]
    since = done if last is None else done.where((F.col("version") == last) & F.col("merged") | (F.col("version") > last))
    return since.orderBy("version").collect()   # one row per batch since the last merge


def _read_versions(spark: SparkSession, table_path: str, listed: list) -> DataFrame:
    """All rows of the versions; duplicates of one key may lie in several."""
    parts = [(kind, [f"{table_path}/{kind}/version={r['version']}" for r in listed if r["merged"] == (kind == "merged")]) for kind in ("merged", "data")]
    frames = [_stored(spark, *paths, base=f"{table_path}/{kind}").drop("version") for kind, paths in parts if paths]
    return frames[0] if len(frames) == 1 else frames[0].unionByName(frames[1])


def read_ingested(spark: SparkSession, table_path: str, before: int | None = None, tie=None) -> DataFrame | None:
    """The exact table of the finished batches (of those below ``before``), each key once (W9); None if there is none yet.

    ``tie`` is that of the ingest; building_id's ``bucket`` prunes a lookup.
    """
    listed = _listed(spark, table_path, before)
    if not listed:
        return None
    rows = _read_versions(spark, table_path, listed)
    return rows if all(r["merged"] for r in listed) else drop_duplicates_first(rows, key=["bucket", *S.DUPLICATE_KEY], tie=tie)


def _write_version(rows: DataFrame, table_path: str, kind: str, batch_id: int) -> int:
    """Stores ``rows`` as the batch's version, in place of what an earlier run of it left; their number."""
    path = f"{table_path}/{kind}/version={batch_id}"
    rows.write.mode("overwrite").option("compression", "zstd").partitionBy("bucket").parquet(path)
    stored = _stored(rows.sparkSession, path)
    return 0 if stored is None else stored.count()


def merge_batch(batch: DataFrame, batch_id: int, table_path: str, buckets: int = BUCKETS, tie=None) -> None:
    """Adds one batch as a version in buckets of buildings; merges all versions, without duplicates (W9), when they have outgrown the last merge.

    Versions are named by batch, older ones are not touched, and a version
    counts once the batch is listed as done.  So a batch that runs again after
    a failure starts from the same rows and replaces its own version.  ``tie`` orders
    the rows of one key (by default all other columns), so the row that stays does not depend on the order of arrival.
    """
    spark = batch.sparkSession
    rows, merged = _write_version(batch.withColumn("bucket", F.pmod(F.xxhash64("building_id"), F.lit(buckets)).cast("int")), table_path, "data", batch_id), False
    if not rows:
        return
    own = spark.createDataFrame([(batch_id, rows, False)], "version long, rows long, merged boolean")
    listed = _listed(spark, table_path, before=batch_id) + own.collect()
    late = [r["rows"] for r in listed if not r["merged"]]
    if len(late) >= MERGE_VERSIONS and sum(late) >= MERGE_GROWTH * sum(r["rows"] for r in listed if r["merged"]):
        whole = drop_duplicates_first(_read_versions(spark, table_path, listed), key=["bucket", *S.DUPLICATE_KEY], tie=tie)
        rows, merged = _write_version(whole, table_path, "merged", batch_id), True
    done = spark.createDataFrame([(rows, merged)], "rows long, merged boolean")
    done.coalesce(1).write.mode("overwrite").parquet(f"{table_path}/done/version={batch_id}")


def start_exact_ingest(spark: SparkSession, landing: str, table_path: str, checkpoint: str | None = None,
                       buckets: int = BUCKETS, tie=None, max_files_per_trigger: int = 100, available_now: bool = True):
    """S7 with W9: validated records of landed files, each key once, whatever files repeat; returns the StreamingQuery.

    Runs ``merge_batch`` on every micro-batch and needs no watermark: keys are
    compared with the stored table, not with a window of state.  A batch adds its own rows;
    the table is rewritten only when it has grown ``MERGE_GROWTH`` fold.
    """
    import hashlib

    base = ensure_checkpoint_dir(spark).rstrip("/")
    checkpoint = checkpoint or f"{base}/exact-{hashlib.sha1(table_path.encode()).hexdigest()[:16]}"
    stream = validate_stream(landed_records(spark, landing, max_files_per_trigger))
    writer = (stream.writeStream.option("checkpointLocation", checkpoint)
              .foreachBatch(lambda batch, batch_id: merge_batch(batch, batch_id, table_path, buckets, tie)))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
