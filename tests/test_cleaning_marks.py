"""The marks of the cleaning steps, the rejected records and the one-scan encoder against plain versions."""

from pyspark.sql import functions as F

from upkeep.operators import encode as EN
from upkeep.operators import quality as Q
from upkeep.operators.score import summary_values
from upkeep.operators.stats import exact_median
from tests.conftest import rec

AS_OF = "2024-06-01"


def some_records():
    rows = [rec(building_id=1, date=f"2024-01-{d:02d} 00:00:00", cost=None if d % 5 == 0 else float(d)) for d in range(1, 14)]
    rows += [rec(building_id=1, date="2024-01-01 00:00:00", cost=c) for c in (7.0, 8.0)]           # copies of a clean key
    rows += [rec(building_id=1, date="2024-01-02 00:00:00", area=-1.0)] * 3                         # copies that break a rule
    rows += [rec(building_id=2, date="2024-01-02 00:00:00")]                                        # sparse building
    rows += [rec(building_id=1, date="1999-01-01 00:00:00")] * 2                                    # too old, twice
    rows += [rec(building_id=1, asset_type=None), rec(building_id=1, date=None)]                    # essentials
    rows += [rec(building_id=1, cost=None, technician=None, period=None, city=None, country=None)]  # 5 of 14 missing
    return rows


def plain(df):
    """The seven steps one after the other, each counted."""
    steps = [df]
    steps.append(Q.drop_missing_essentials(Q.ensure_required_columns(steps[-1])))
    steps.append(Q.drop_invalid_types(Q.coerce_types(steps[-1])))
    steps.append(Q.handle_missing(steps[-1]))
    steps.append(Q.drop_rule_violations(steps[-1]))
    steps.append(Q.drop_duplicates_first(steps[-1]))
    steps.append(Q.filter_date_range(steps[-1], AS_OF))
    steps.append(Q.drop_sparse_buildings(steps[-1]))
    return steps


def test_marks_agree_with_steps_one_by_one(make_records):
    df = make_records(some_records())
    steps = plain(df)
    counts = [s.count() for s in steps]
    for checkpoint in (False, True):
        res = Q.clean(df, as_of=AS_OF, checkpoint=checkpoint)
        report = res.report().orderBy("step").collect()
        assert [r.records_after for r in report] == counts[1:]
        assert [r.records_removed for r in report] == [a - b for a, b in zip(counts, counts[1:])]
        assert res.data.columns == df.columns
        assert sorted(map(str, res.data.collect())) == sorted(map(str, steps[-1].select(*df.columns).collect()))


def test_rejected_records_name_their_stage(make_records):
    gone = Q.clean(make_records(some_records()), as_of=AS_OF).rejected()
    got = {r.stage: (r.rows, r.copies) for r in gone.groupBy("stage").agg(F.count("*").alias("rows"), F.sum("copies").alias("copies")).collect()}
    assert got == {"missing_columns": (2, 2), "excessive_missing": (1, 1), "business_logic": (1, 3), "invalid_dates": (1, 2),
                   "insufficient_building_data": (1, 1)}


def test_no_records(make_records):
    res = Q.clean(make_records([]), as_of=AS_OF)
    assert res.data.count() == 0 and res.rejected().count() == 0
    assert [(r.records_after, r.records_removed) for r in res.report().collect()] == [(0, 0)] * 7


def test_nan_counts_as_lacking(spark):
    df = spark.createDataFrame([(1.0, "x"), (float("nan"), "x"), (None, "x"), (2.0, None)], "a double, b string")
    lacking = Q._lacking(df, ["a", "b"])
    assert df.filter(~lacking).count() == df.dropna(subset=["a", "b"]).count() == 1


def test_weighted_median_is_that_of_repeated_rows(spark):
    rows = [("a", 1.0, 5), ("a", 9.0, 4), ("a", 2.0, 2), ("b", 3.0, 1), ("b", 4.0, 1), ("b", None, 7)]
    df = spark.createDataFrame(rows, "k string, v double, n long")
    flat = df.select("k", "v", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))))
    want = {r.k: r["median"] for r in exact_median(flat, ["k"], "v").collect()}
    assert {r.k: r["median"] for r in exact_median(df, ["k"], "v", weight="n").collect()} == want == {"a": 2.0, "b": 3.5}


def test_value_counts_leaves_nulls_out(make_records):
    df = make_records([rec(city="x"), rec(city="x"), rec(city=None), rec(city="", technician=3)])
    got = {(r.feature, r.value): r.rows for r in EN.value_counts(df, ["city", "technician_id"]).collect()}
    assert got == {("city", "x"): 2, ("city", ""): 1, ("technician_id", "7"): 3, ("technician_id", "3"): 1}
    assert EN.value_counts(df, []).count() == 0
    assert {r.value for r in summary_values(df, ["city"]).collect()} == {"x", ""}


def test_fit_of_a_column_without_values(make_records):
    df = make_records([rec(city=None, country=None), rec(city=None, country=None, date="2024-02-01 00:00:00")])
    enc = EN.fit(df)
    assert enc.onehot["city"] == [] and enc.onehot["country"] == [] and enc.onehot["asset_type"] == ["HVAC"]
    assert EN.apply_encoding(df, enc).first()["asset_type_HVAC"] == 1.0
