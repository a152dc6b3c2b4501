"""Report windows, prediction history, exact ingest and document shapes on hand-made rows."""
import json
import os
import random
import tempfile
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from upkeep import schema as S
from upkeep.operators.quality import drop_duplicates_first
from upkeep.sources import extract as EX
from upkeep.sources import history as H
from upkeep.sources import readers as RD
from upkeep.streaming import landed as LA


def test_report_windows_against_all_pairs(spark):
    r = random.Random(2)
    day = lambda: datetime(2020, 1, 1) + timedelta(hours=r.randrange(0, 24 * 400))
    checks = [(b, day()) for b in (1, 1, 1, 2, 3) for _ in range(30)] + [(None, day()), (5, None), (1, datetime(2021, 6, 1)), (1, datetime(2021, 6, 1))]
    reports = [(b, day()) for b in (1, 2, 4) for _ in range(20)] + [(1, datetime(2021, 5, 2)), (1, None), (None, day())]
    reports += [(2, checks[100][1] + timedelta(days=10)), (3, checks[130][1] - timedelta(days=30)), (3, checks[131][1] + timedelta(days=90))]
    c, p = spark.createDataFrame(checks, "building_id long, maintenance_date timestamp"), spark.createDataFrame(reports, "building_id long, created_at timestamp")
    want = {(b, d): any(x == b and t is not None and d - timedelta(days=30) <= t <= d + timedelta(days=90) for x, t in reports) for b, d in checks if b is not None and d is not None}
    for max_rows in (None, 10):
        got = EX.reports_in_window(c, p, 30, 90, max_rows=max_rows).collect()
        assert {(x["building_id"], x["maintenance_date"]): x["_reported"] for x in got} == want and len(got) == len(want)
    assert set(want.values()) == {True, False}


def test_a_repeated_run_replaces_its_own_predictions(spark):
    path = tempfile.mkdtemp(prefix="upkeep-hist-", dir="/tmp") + "/h"
    rows = [(b, a, datetime(2024, 1, 1 + k), 0.1 * k) for k in range(3) for b in (1, 2, 3) for a in ("lift", "boiler")]
    df = spark.createDataFrame(rows, "building_id long, asset_type string, prediction_date timestamp, maintenance_probability double")
    for run in ("x", "x", "y", "x"):
        H.append_predictions(df, path, run_id=run)
    H.append_predictions(df.where("building_id = 1"), path)
    got = H.prediction_history(spark, path, 2, "lift").collect()
    assert len(got) == 6 and [r["prediction_date"] for r in got] == sorted((r["prediction_date"] for r in got), reverse=True)
    assert H.prediction_history(spark, path, 1).count() == 6 * 2 + 6 and H.prediction_history(spark, path, 99).count() == 0
    plan = H.prediction_history(spark, path, 2)._jdf.queryExecution().executedPlan().toString()
    assert "building_bucket" in plan.split("PartitionFilters")[1].split("]")[0]


REC = {"building_id": 1, "building_type": "r", "asset_type": "lift", "maintenance_type": "preventive", "maintenance_date": "2024-03-01T10:00:00Z", "failure_reported": "false",
       "downtime_days": 0, "maintenance_cost": 10.0, "technician_id": 2, "period_days": 30, "city": "c", "country": "k", "building_area": 10.0, "building_floors": 1}


def test_exact_ingest_of_repeated_files_and_batches(spark):
    land, out, ck = (tempfile.mkdtemp(prefix=f"upkeep-{k}-", dir="/tmp") for k in ("land", "out", "ck"))
    table = f"{out}/t"
    assert LA.read_ingested(spark, table) is None
    for k, cost in enumerate((30.0, 20.0, 25.0)):  # one key with three contents, and one key of its own a file; the second file again
        with open(os.path.join(land, f"{k}.json"), "w") as f:
            for rec in (dict(REC, maintenance_cost=cost), dict(REC, building_id=10 + k), dict(REC, building_area=0)):
                f.write(json.dumps(rec) + "\n")
        LA.start_exact_ingest(spark, land, table, checkpoint=ck, buckets=4).awaitTermination(120)
    got = {r["building_id"]: r["maintenance_cost"] for r in LA.read_ingested(spark, table).collect()}
    assert LA.read_ingested(spark, table).count() == 4 and got == {1: 20.0, 10: 10.0, 11: 10.0, 12: 10.0}
    # a batch that runs again after a failure leaves the same table
    batch = LA.validate_stream(RD.read_json(spark, f"{land}/2.json", multi_line=False))
    LA.merge_batch(batch, 2, table, buckets=4)
    again = LA.read_ingested(spark, table).drop("bucket", "version")
    rows = RD.read_json(spark, land, multi_line=False)
    want = drop_duplicates_first(LA.validate_stream(rows))
    assert sorted(map(tuple, again.select(*want.columns).collect())) == sorted(map(tuple, want.collect()))


def test_shapes_are_read_in_one_scan_and_bad_documents_are_counted(spark):
    d = tempfile.mkdtemp(prefix="upkeep-doc-", dir="/tmp")
    lines = [[REC, dict(REC, building_id=8)], {"data": [REC]}, REC, {"maintenance_records": [dict(REC, record_id=1)]}, {"data": []}, []]
    with open(f"{d}/x.json", "w") as f:
        f.write("\n".join([*map(json.dumps, lines), "{broken", ""]))
    got = RD.read_json(spark, d, multi_line=False)
    assert got.count() == 6 and got.where("building_id is null").count() == 1
    assert got._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    pretty = tempfile.mkdtemp(prefix="upkeep-doc-", dir="/tmp")
    for k, x in enumerate(lines[:4]):
        with open(f"{pretty}/{k}.json", "w") as f:
            json.dump(x, f, indent=2)
    assert RD.read_json(spark, pretty).count() == 5
    row = RD.read_json(spark, pretty).first()
    assert row["maintenance_cost"] == 10.0 and row["failure_reported"] is False and row["building_floors"] == 1


def test_exact_ingest_writes_rows_a_bounded_number_of_times(spark, monkeypatch):
    """Batches of new rows and repeats of old ones: merges by growth, each key once, a batch run again changes nothing, and the rows written follow the rows landed."""
    monkeypatch.setattr(LA, "MERGE_VERSIONS", 3)
    table = tempfile.mkdtemp(prefix="upkeep-many-", dir="/tmp") + "/t"
    schema = S.RECORD_SCHEMA

    def batch(k):
        rows = [(b, "r", "lift", "preventive", datetime(2024, 1, 1), False, 0, float(k), 1, 30, "c", "k", 10.0, 1) for b in (*range(5 * k, 5 * k + 5), 0)]
        return spark.createDataFrame(rows, schema)

    for k in range(20):
        LA.merge_batch(batch(k), k, table, buckets=2)
    LA.merge_batch(batch(19), 19, table, buckets=2)
    got = sorted((r["building_id"], r["maintenance_cost"]) for r in LA.read_ingested(spark, table).collect())
    assert got == [(b, float(b // 5)) for b in range(100)]
    written = sum(spark.read.parquet(f"{table}/{kind}").count() for kind in ("data", "merged"))
    assert 120 < written <= 2 * 120
    assert LA.read_ingested(spark, table, before=7).count() == 35
