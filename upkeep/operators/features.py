"""Label and engineered features per maintenance record.

All ordered features (gaps, next-event distance, rolling means, trends,
running totals, counts) come from ONE segmented window pass partitioned by
(building_id, asset_type, segment) - see ``scan.py`` - and every whole-group
statistic comes from one partial aggregate per (building, asset) that is
rolled up to building and asset level and joined back on the same key as
the window partitioning, so the large side is shuffled once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from upkeep import schema as S
from upkeep.functions.expressions import (age_years, cost_category, day_of_week_monday0,
                                          height_category, safe_ratio, season, size_category,
                                          whole_days_between)
from upkeep.operators.scan import (DEFAULT_MAX_ROWS, HOT_WIDTH, SEG, checked_broadcast, ordered_scan,
                                   segment)
from upkeep.operators.stats import broadcast_if_small
from upkeep.session import materialize

KEYS = ["building_id", "asset_type"]
MONEY = "decimal(24,6)"   # exact running sums independent of summation order


def _avg3(cur: Column, l1: Column, l2: Column) -> Column:
    """Mean of the non-null values among the current and two previous rows."""
    total = F.coalesce(cur, F.lit(0.0)) + F.coalesce(l1, F.lit(0.0)) + F.coalesce(l2, F.lit(0.0))
    n = cur.isNotNull().cast("int") + l1.isNotNull().cast("int") + l2.isNotNull().cast("int")
    return F.when(n > 0, total / n)


def group_stats(df: DataFrame) -> DataFrame:
    """One row per (building, asset): count, date range, failure counts."""
    fail = F.col("failure_reported")
    prev = F.col("maintenance_type") == "preventive"
    return df.groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("_n"),
        F.min("_x").alias("_lo"), F.max("_x").alias("_hi"),
        F.count_if(fail).alias("_f"), F.count(fail).alias("_fn"),
        F.count_if(prev & fail).alias("_pf"), F.count(F.when(prev, fail)).alias("_pfn"))


def engineer(df: DataFrame, tie: list, max_rows: int = DEFAULT_MAX_ROWS,
             reference_date: str = S.AGE_REFERENCE_DATE,
             horizon_days: int = S.PREDICTION_HORIZON_DAYS) -> DataFrame:
    """Cleaned records -> records + label + engineered features."""
    x = F.unix_micros("maintenance_date").cast("double")
    base = df.withColumn("_x", x)
    # one row per (building, asset); read by the hot-group check and by the
    # building / asset roll-ups, so it is stored once
    stats = materialize(group_stats(base))
    seg = segment(base.drop("_x"), KEYS, x, max_rows=max_rows, stats=stats)
    order = [F.col("maintenance_date")] + [F.col(c) for c in tie]
    cost, down = F.col("maintenance_cost"), F.col("downtime_days")
    scanned = ordered_scan(
        seg, order,
        sums={"_cum_cost": cost.cast(MONEY), "_cum_down": down},
        lags={"maintenance_date": 1, "maintenance_cost": 2, "downtime_days": 2},
        leads={"maintenance_date": 1},
        position="maintenance_count")

    # Whole-group statistics, rolled up from the (building, asset) aggregate.
    bstats = stats.groupBy("building_id").agg(
        safe_ratio(F.sum("_f"), F.sum("_fn")).alias("building_failure_rate"),
        F.count("asset_type").alias("asset_density"))
    astats = stats.groupBy("asset_type").agg(
        safe_ratio(F.sum("_f"), F.sum("_fn")).alias("asset_failure_rate"))
    span = F.floor((F.col("_hi") - F.col("_lo")) / F.lit(86_400_000_000.0))
    freq = (F.when((F.col("_n") < 2) | (span < S.MIN_FREQUENCY_SPAN_DAYS), F.lit(S.DEFAULT_FREQUENCY))
            .otherwise(F.col("_n") / (span / F.lit(S.DAYS_PER_YEAR))))
    gcols = [freq.alias("maintenance_frequency"),
             safe_ratio(F.col("_pf"), F.col("_pfn")).alias("_prev_fail_rate"),
             "building_failure_rate", "asset_failure_rate", "asset_density"]
    gfull = stats.join(bstats, "building_id").join(broadcast_if_small(astats), "asset_type")
    if seg.has_hot:
        # ordinary groups are segment 0; hot groups get one row per actual segment
        hot = F.col("_n") > F.lit(max_rows)
        gstats = (gfull.filter(~hot).select(*KEYS, F.lit(0).cast("long").alias(SEG), *gcols)
                  .unionByName(gfull.filter(hot).join(checked_broadcast(seg.segments), KEYS)
                               .select(*KEYS, SEG, *gcols)))
    else:
        gstats = gfull.select(*KEYS, F.lit(0).cast("long").alias(SEG), *gcols)
    cities = broadcast_if_small(
        df.groupBy("city").agg(F.countDistinct("building_id").alias("city_building_count"))
        .filter(F.col("city").isNotNull()))

    j = (scanned.join(gstats, on=[*KEYS, SEG], how="left")
         .join(cities, on="city", how="left"))

    d = F.col("maintenance_date")
    gap = whole_days_between(d, F.col("lag1_maintenance_date"))
    to_next = whole_days_between(F.col("lead1_maintenance_date"), d)
    period = F.col("period_days")
    label = F.coalesce((to_next <= horizon_days) | (F.col("failure_reported") == F.lit(True))
                       | (period.isNotNull() & (gap > period * F.lit(S.OVERDUE_FACTOR))), F.lit(False))
    month = F.month(d)
    feats = {
        "days_to_next_maintenance": to_next,
        "maintenance_needed": label,
        "days_since_last_maintenance": F.coalesce(gap, period, F.lit(S.DEFAULT_PERIOD_DAYS).cast("long")),
        "maintenance_month": month,
        "maintenance_quarter": F.quarter(d),
        "maintenance_day_of_week": day_of_week_monday0(d),
        "maintenance_season": season(month),
        "building_age_years": age_years(d, reference_date),
        "maintenance_cost_per_sqm": F.coalesce(safe_ratio(cost, F.col("building_area")), F.lit(0.0)),
        "maintenance_cost_category": cost_category(cost),
        "downtime_cost_ratio": safe_ratio(down, cost + F.lit(1.0)),
        "preventive_effectiveness": F.when(F.col("maintenance_type") == "preventive",
                                           F.lit(1.0) - F.col("_prev_fail_rate")).otherwise(F.lit(0.0)),
        "area_per_floor": safe_ratio(F.col("building_area"), F.col("building_floors")),
        "building_size_category": size_category(F.col("building_area")),
        "building_height_category": height_category(F.col("building_floors")),
        "maintenance_cost_rolling_mean": _avg3(cost, F.col("lag1_maintenance_cost"),
                                               F.col("lag2_maintenance_cost")),
        "downtime_rolling_mean": _avg3(down.cast("double"), F.col("lag1_downtime_days").cast("double"),
                                       F.col("lag2_downtime_days").cast("double")),
        "cost_trend": F.coalesce(cost - F.col("lag1_maintenance_cost"), F.lit(0.0)),
        "downtime_trend": F.coalesce((down - F.col("lag1_downtime_days")).cast("double"), F.lit(0.0)),
        "cumulative_maintenance_cost": F.when(cost.isNotNull(), F.col("_cum_cost").cast("double")),
        "cumulative_downtime": F.when(down.isNotNull(), F.col("_cum_down")),
        "maintenance_count": F.col("maintenance_count").cast("long"),
    }
    out = j.withColumns(feats)
    drop = ["lag1_maintenance_date", "lead1_maintenance_date", "lag1_maintenance_cost",
            "lag2_maintenance_cost", "lag1_downtime_days", "lag2_downtime_days", "_cum_cost",
            "_cum_down", "_prev_fail_rate", SEG, HOT_WIDTH]
    return out.drop(*drop)


FEATURE_COLUMNS = [
    "days_to_next_maintenance", "maintenance_needed", "days_since_last_maintenance",
    "maintenance_frequency", "maintenance_month", "maintenance_quarter", "maintenance_day_of_week",
    "maintenance_season", "building_age_years", "maintenance_cost_per_sqm",
    "maintenance_cost_category", "downtime_cost_ratio", "building_failure_rate",
    "asset_failure_rate", "preventive_effectiveness", "area_per_floor", "building_size_category",
    "building_height_category", "asset_density", "city_building_count",
    "maintenance_cost_rolling_mean", "downtime_rolling_mean", "cost_trend", "downtime_trend",
    "cumulative_maintenance_cost", "cumulative_downtime", "maintenance_count",
]
