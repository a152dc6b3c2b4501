"""Prediction history sink (K4) and lookup (K5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from upkeep.session import released_shuffles

HISTORY_BUCKETS = 64


def bucket_of(building_id, buckets: int = HISTORY_BUCKETS):
    return F.pmod(F.xxhash64(building_id.cast("long")), F.lit(buckets)).cast("int")


def append_predictions(scored: DataFrame, path: str, buckets: int = HISTORY_BUCKETS, run_id: str | None = None) -> None:
    """Append scored rows, partitioned by a building hash bucket, the day and the run.

    The bucket lets a per-building lookup prune to one directory per day and
    run.  With ``run_id`` an append that is repeated (a retried job) replaces
    what the same run wrote to these directories instead of doubling it; without one every append adds rows.
    """
    out = scored
    if "prediction_date" not in out.columns:
        out = out.withColumn("prediction_date", F.current_timestamp())
    out = (out.withColumn("building_bucket", bucket_of(F.col("building_id"), buckets))
           .withColumn("prediction_day", F.to_date("prediction_date")).withColumn("run_id", F.lit(run_id or "-")))
    # bucket and day spread over tasks, so that a hot building's days do not share one
    out = out.repartition("building_bucket", "prediction_day", F.pmod(F.xxhash64("building_id", "asset_type"), F.lit(8)))
    writer = out.write.mode("overwrite" if run_id else "append").option("partitionOverwriteMode", "dynamic").option("compression", "zstd")
    with released_shuffles(scored.sparkSession):   # of whole rows, which would lie beside those of the next append
        writer.partitionBy("building_bucket", "prediction_day", "run_id").parquet(path)


def prediction_history(spark: SparkSession, path: str, building_id: int, asset_type: str | None = None,
                       buckets: int = HISTORY_BUCKETS) -> DataFrame:
    """Predictions of one building (optionally one asset), newest first; only its bucket's directories are read."""
    bucket = spark.range(1).select(bucket_of(F.lit(building_id), buckets)).first()[0]
    df = (spark.read.option("mergeSchema", "false").parquet(path)
          .filter((F.col("building_bucket") == bucket) & (F.col("building_id") == building_id)))
    if asset_type is not None:
        df = df.filter(F.col("asset_type") == asset_type)
    return df.orderBy(F.col("prediction_date").desc())
