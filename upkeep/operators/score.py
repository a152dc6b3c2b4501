"""Scoring: rule-based risk, probability buckets and batch model scoring."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from upkeep import schema as S
from upkeep.functions.expressions import confidence, risk_category, timeframe_days, whole_days_between
from upkeep.operators.encode import value_counts


def rule_risk(df: DataFrame, as_of: str, critical_assets=S.RULE_RISK_CRITICAL_ASSETS,
              weights=S.RULE_RISK_WEIGHTS, age_days: int = S.RULE_RISK_AGE_DAYS, costs: DataFrame | None = None) -> DataFrame:
    """additive rule score over every record (not a sample), capped at 1.

    +0.3 last maintenance older than 90 days at ``as_of``; +0.4 failure
    reported; +0.2 critical asset type; +0.1 cost above the overall mean.
    The mean is one aggregate value (a single row), used as a literal.
    ``costs``: the same records as a table that is cheaper to read, for the mean.
    """
    mean_cost = (df if costs is None else costs).agg(F.avg("maintenance_cost")).first()[0]
    age = whole_days_between(F.to_timestamp(F.lit(as_of)), F.col("maintenance_date"))
    zero = F.lit(0.0)
    parts = [
        F.when(age > age_days, F.lit(weights["age"])).otherwise(zero),
        F.when(F.col("failure_reported") == F.lit(True), F.lit(weights["failure"])).otherwise(zero),
        F.when(F.col("asset_type").isin(*critical_assets), F.lit(weights["critical_asset"])).otherwise(zero),
        F.when(F.col("maintenance_cost") > F.lit(mean_cost), F.lit(weights["high_cost"])).otherwise(zero)
        if mean_cost is not None else zero,
    ]
    score = zero
    for p in parts:
        score = score + p
    score = F.least(score, F.lit(1.0))
    level = F.when(score < 0.3, "LOW").when(score < 0.7, "MEDIUM").otherwise("HIGH")
    return df.withColumn("risk_score", score).withColumn("risk_level", level)


def probability_outputs(df: DataFrame, p: str = "maintenance_probability",
                        model_version: str | None = None, prediction_date: str | None = None) -> DataFrame:
    """Risk category, expected timeframe and confidence per probability."""
    col = F.col(p)
    out = df.withColumns({
        "risk_category": risk_category(col),
        "predicted_timeframe_days": timeframe_days(col),
        "confidence_score": confidence(col),
    })
    if model_version is not None:
        out = out.withColumn("model_version", F.lit(model_version))
    if prediction_date is not None:
        out = out.withColumn("prediction_date", F.to_timestamp(F.lit(prediction_date)))
    return out


def data_summary(df: DataFrame) -> DataFrame:
    """One-row summary of a record set.

    The two lists are for columns of few values; ``summary_values`` gives values of any number as rows.
    """
    return df.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.countDistinct("building_id").alias("buildings"),
        F.array_join(F.sort_array(F.collect_set("country")), ", ").alias("countries"),
        F.array_join(F.sort_array(F.collect_set("asset_type")), ", ").alias("asset_types"),
        F.date_format(F.min("maintenance_date"), "yyyy-MM-dd").alias("first_date"),
        F.date_format(F.max("maintenance_date"), "yyyy-MM-dd").alias("last_date"),
        F.avg("maintenance_cost").alias("avg_cost"),
        F.round(F.sum(F.col("maintenance_cost").cast("decimal(24,6)")), 4).cast("double").alias("total_cost"),
        (F.count_if(F.col("failure_reported")) * 100.0 / F.count(F.lit(1))).alias("failure_rate_pct"))


def summary_values(df: DataFrame, columns=("country", "asset_type")) -> DataFrame:
    """The values of ``columns`` and their records, a row each (feature, value, rows)."""
    return value_counts(df, list(columns))


def asset_distribution(df: DataFrame) -> DataFrame:
    """Records per asset type, most frequent first."""
    return df.groupBy("asset_type").agg(F.count(F.lit(1)).alias("records")).orderBy(
        F.col("records").desc(), F.col("asset_type"))
