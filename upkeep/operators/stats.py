"""Grouped statistics that stay exact without pulling a group into one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from upkeep.operators.scan import DEFAULT_MAX_ROWS, ordered_scan, segment
from upkeep.session import materialize

_G = "_all"


def broadcast_if_small(small: DataFrame, max_rows: int = 1_000_000) -> DataFrame:
    """Broadcast a derived table only after checking its size.

    The table is first written to the cluster's shared checkpoint folder
    (``spark.checkpoint.dir``), so the size check does not recompute it and
    executor loss after this point does not replay its lineage.  Above
    ``max_rows`` the table is returned as is and the join stays a shuffle join.
    """
    small = materialize(small)
    if small.limit(max_rows + 1).count() <= max_rows:
        return F.broadcast(small)
    return small


def _with_group(df: DataFrame, keys: list) -> tuple[DataFrame, list]:
    if keys:
        return df, list(keys)
    return df.withColumn(_G, F.lit(0)), [_G]


def exact_median(df: DataFrame, keys: list, col: str, out: str = "median",
                 max_rows: int = DEFAULT_MAX_ROWS, weight: str | None = None) -> DataFrame:
    """Exact median per group (mean of the two middle values), nulls skipped.

    ``weight`` names a column that says how many rows a row stands for.

    Works on distinct (group, value) counts - a partial aggregate - then a
    segmented running count locates the middle ranks, so even a single group
    with all rows and many distinct values is spread over many tasks.
    """
    df, gkeys = _with_group(df.filter(F.col(col).isNotNull()), keys)
    # stored, as the sizes, the running count and the totals read it: ``df`` is read once
    counts = materialize(df.groupBy(*gkeys, col).agg((F.sum(weight) if weight else F.count(F.lit(1))).alias("_c")))
    seg = segment(counts, gkeys, col, max_rows=max_rows)
    run = ordered_scan(seg, order=[F.col(col)], sums={"_cum": F.col("_c")})
    totals = counts.groupBy(*gkeys).agg(F.sum("_c").alias("_n"))
    k1 = F.floor((F.col("_n") + 1) / 2)
    k2 = F.floor(F.col("_n") / 2) + 1
    lo = F.col("_cum") - F.col("_c")
    hit1 = (lo < k1) & (k1 <= F.col("_cum"))
    hit2 = (lo < k2) & (k2 <= F.col("_cum"))
    picked = (run.join(totals, on=gkeys).filter(hit1 | hit2)
              .groupBy(*gkeys)
              .agg(((F.max(F.when(hit1, F.col(col))) + F.max(F.when(hit2, F.col(col)))) / 2.0)
                   .cast("double").alias(out)))
    return picked if keys else picked.drop(_G)


def exact_quantile(df: DataFrame, keys: list, col: str, share: float, out: str = "quantile",
                   max_rows: int = DEFAULT_MAX_ROWS) -> DataFrame:
    """Exact quantile per group: the smallest value with at least ``share`` of the group's rows up to it, nulls skipped.

    As ``exact_median``: distinct (group, value) counts and a segmented
    running count, so that no task holds a group.  Keys must not be null.
    """
    df, gkeys = _with_group(df.filter(F.col(col).isNotNull()), keys)
    counts = df.groupBy(*gkeys, col).agg(F.count(F.lit(1)).alias("_c"))
    seg = segment(counts, gkeys, col, max_rows=max_rows)
    run = ordered_scan(seg, order=[F.col(col)], sums={"_cum": F.col("_c")})
    totals = counts.groupBy(*gkeys).agg(F.sum("_c").alias("_n"))
    picked = (run.join(totals, on=gkeys).filter(F.col("_cum") >= F.lit(float(share)) * F.col("_n"))
              .groupBy(*gkeys).agg(F.min(col).alias(out)))
    return picked if keys else picked.drop(_G)


def lowest_mode(df: DataFrame, keys: list, col: str, out: str = "mode") -> DataFrame:
    """Most frequent non-null value per group; ties go to the smallest value.

    Two partial aggregates (value counts, then arg-max by count), so a hot
    group never sits in one task.
    """
    counts = (df.filter(F.col(col).isNotNull()).groupBy(*keys, col)
              .agg(F.count(F.lit(1)).alias("_c")))
    best = counts.groupBy(*keys).agg(
        F.max(F.struct(F.col("_c"), (-F.col(col)).alias("_neg"))).alias("_best"))
    return best.select(*keys, (-F.col("_best._neg")).cast(df.schema[col].dataType).alias(out))
