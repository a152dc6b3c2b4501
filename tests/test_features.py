from pyspark.sql import functions as F

from upkeep.operators import features as FE
from tests.conftest import rec

TIE = ["ord"]


def _feats(make_records, rows, **kw):
    df = make_records(rows)
    df = df.withColumn("ord", F.unix_micros("maintenance_date"))
    return FE.engineer(df, tie=TIE, **kw).orderBy("building_id", "asset_type", "maintenance_date")


def test_rolling_and_running_with_nulls(make_records):
    rows = [rec(date=f"2024-0{i + 1}-01 00:00:00", cost=c) for i, c in enumerate([1.0, None, 3.0, 5.0])]
    out = _feats(make_records, rows).collect()
    assert [r.maintenance_cost_rolling_mean for r in out] == [1.0, 1.0, 2.0, 4.0]
    assert [r.cumulative_maintenance_cost for r in out] == [1.0, None, 4.0, 9.0]
    assert [r.maintenance_count for r in out] == [1, 2, 3, 4]


def test_single_row_group(make_records):
    out = _feats(make_records, [rec(period=None, mtype="corrective")]).first()
    assert out.days_since_last_maintenance == 90
    assert out.maintenance_frequency == 2.0
    assert out.cost_trend == 0.0 and out.maintenance_count == 1


def test_short_span_frequency(make_records):
    rows = [rec(date=d) for d in ("2024-01-01 00:00:00", "2024-01-15 00:00:00", "2024-01-30 00:00:00")]
    assert {r.maintenance_frequency for r in _feats(make_records, rows).collect()} == {2.0}


def test_label_cases(make_records):
    # gap 61 days with period 50 -> overdue; gap 60 -> not (1.2 * 50 = 60)
    rows = [rec(building_id=1, date="2024-01-01 00:00:00", period=50),
            rec(building_id=1, date="2024-03-02 00:00:00", period=50),    # 61 days later
            rec(building_id=2, date="2024-01-01 00:00:00", period=50),
            rec(building_id=2, date="2024-03-01 00:00:00", period=50)]    # 60 days later
    out = _feats(make_records, rows).collect()
    last1 = [r for r in out if r.building_id == 1][-1]
    last2 = [r for r in out if r.building_id == 2][-1]
    assert last1.maintenance_needed is True
    assert last2.maintenance_needed is False
    first = [r for r in out if r.building_id == 1][0]
    assert first.days_to_next_maintenance == 61 and first.maintenance_needed is True


def test_label_na_is_false(make_records):
    out = _feats(make_records, [rec(period=50, failure=False)]).first()
    assert out.maintenance_needed is False


def test_hot_groups_match_plain_windows(spark):
    """Segmented scan with tiny segments equals the one-task-per-group result."""
    from tests.conftest import rec as r
    rows = []
    for i in range(60):
        rows.append(r(building_id=1 + (i % 2), asset_type="A" if i % 3 else "B",
                      date=f"2024-{1 + i % 12:02d}-{1 + (i * 7) % 28:02d} {i % 24:02d}:00:00",
                      cost=None if i % 11 == 0 else float(i), downtime=i % 4,
                      failure=i % 5 == 0, period=30 + i % 3, technician=i))
    from upkeep.schema import RECORD_SCHEMA
    df = spark.createDataFrame(rows, RECORD_SCHEMA).withColumn("ord", F.col("technician_id"))
    cols = [c for c in FE.FEATURE_COLUMNS]
    a = FE.engineer(df, tie=["ord"]).select("building_id", "asset_type", "maintenance_date", "ord", *cols)
    b = FE.engineer(df, tie=["ord"], max_rows=4).select("building_id", "asset_type", "maintenance_date", "ord", *cols)
    key = ["building_id", "asset_type", "maintenance_date", "ord"]
    ra = [tuple(x) for x in a.orderBy(*key).collect()]
    rb = [tuple(x) for x in b.orderBy(*key).collect()]
    assert ra == rb


def test_bursty_hot_group_is_refined(spark):
    """A burst inside one equal-width segment is cut again; results stay exact."""
    from datetime import datetime, timedelta
    from upkeep.operators.scan import ordered_scan, segment
    base = datetime(2024, 1, 1)
    # 40 rows spread over a year plus 60 rows inside one day
    rows = [(1, base + timedelta(days=9 * i), float(i)) for i in range(40)]
    rows += [(1, base + timedelta(days=100, minutes=i), float(100 + i)) for i in range(60)]
    df = spark.createDataFrame(rows, "g long, t timestamp, v double")
    seg = segment(df, ["g"], F.unix_micros("t"), max_rows=10)
    sizes = [r["count"] for r in seg.df.groupBy("_seg").count().collect()]
    assert max(sizes) <= 10
    got = ordered_scan(seg, [F.col("t")], sums={"run": F.col("v")}, lags={"v": 2}, leads={"v": 1},
                       position="pos").orderBy("t").collect()
    from pyspark.sql import Window
    w = Window.partitionBy("g").orderBy("t")
    ref = df.select("t", F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("run"),
                    F.lag("v", 1).over(w).alias("l1"), F.lag("v", 2).over(w).alias("l2"),
                    F.lead("v", 1).over(w).alias("n1"), F.row_number().over(w).alias("pos")).orderBy("t").collect()
    assert [(r.run, r.lag1_v, r.lag2_v, r.lead1_v, r.pos) for r in got] == \
        [(r.run, r.l1, r.l2, r.n1, r.pos) for r in ref]
