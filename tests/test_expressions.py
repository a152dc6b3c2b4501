from datetime import datetime

from pyspark.sql import functions as F

from upkeep.functions import expressions as X


def _one(spark, expr, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_whole_days_not_calendar_days(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1, 23), datetime(2024, 1, 2, 1))], "a timestamp, b timestamp")
    r = df.select(X.whole_days_between(F.col("b"), F.col("a")).alias("d"),
                  F.datediff("b", "a").alias("cal")).first()
    assert r.d == 0 and r.cal == 1


def test_cost_bins_right_closed(spark):
    vals = [(0.0,), (200.0,), (200.01,), (1000.0,), (1001.0,), (None,)]
    got = _one(spark, X.cost_category(F.col("x")), vals, "x double")
    assert got == [None, "low", "medium", "high", "very_high", None]


def test_monday_is_zero(spark):
    got = _one(spark, X.day_of_week_monday0(F.col("t")), [(datetime(2024, 1, 1),)], "t timestamp")
    assert got == [0]


def test_season(spark):
    got = _one(spark, X.season(F.col("m")), [(12,), (3,), (7,), (10,)], "m int")
    assert got == ["winter", "spring", "summer", "autumn"]


def test_risk_timeframe_confidence(spark):
    rows = [(0.1,), (0.3,), (0.7,), (0.71,), (0.9,)]
    df = spark.createDataFrame(rows, "p double").select(
        X.risk_category(F.col("p")).alias("r"), X.timeframe_days(F.col("p")).alias("t"),
        F.round(X.confidence(F.col("p")), 6).alias("c"))
    got = [tuple(r) for r in df.collect()]
    assert got == [("low", None, 0.6), ("medium", None, 0.6), ("high", 60, 0.84), ("high", 30, 0.852),
                   ("high", 30, 0.95)]


def test_bool_parsing(spark):
    got = _one(spark, X.parse_bool(F.col("s")), [("False",), ("true",), (None,), ("maybe",), ("1",)], "s string")
    assert got == [False, True, None, None, True]
