import json
import os
import tempfile

from upkeep.streaming.landed import start_ingest


def test_landed_exports_stream(spark):
    land = tempfile.mkdtemp(prefix="upkeep-land-", dir="/tmp")
    out = tempfile.mkdtemp(prefix="upkeep-out-", dir="/tmp") + "/t"
    rec = {"building_id": 1, "building_type": "r", "asset_type": "lift", "maintenance_type": "preventive",
           "maintenance_date": "2024-03-01T10:00:00Z", "failure_reported": "false", "downtime_days": 0,
           "maintenance_cost": 10.0, "technician_id": 2, "period_days": 30, "city": "c", "country": "k",
           "building_area": 10.0, "building_floors": 1}
    with open(os.path.join(land, "a.json"), "w") as f:
        f.write(json.dumps(rec) + "\n" + json.dumps(rec) + "\n")            # duplicate key
        f.write(json.dumps(dict(rec, building_area=0)) + "\n")               # rule violation
        f.write(json.dumps(dict(rec, maintenance_date="2024-04-01T00:00:00Z")) + "\n")
    q = start_ingest(spark, land, out, checkpoint=tempfile.mkdtemp(prefix="upkeep-ck-", dir="/tmp"))
    q.awaitTermination(120)
    assert spark.read.parquet(out).count() == 3      # duplicates are the batch chain's


def test_late_files_are_kept(spark):
    """Exports that land newest first, one run each, are all stored."""
    land, out, ck = (tempfile.mkdtemp(prefix=f"upkeep-{k}-", dir="/tmp") for k in ("land", "out", "ck"))
    rec = {"building_id": 1, "building_type": "r", "asset_type": "lift", "maintenance_type": "preventive",
           "failure_reported": "false", "building_area": 10.0, "building_floors": 1}
    for k, day in enumerate(("2024-06-01", "2020-01-05", "2023-01-05")):
        with open(os.path.join(land, f"{k}.json"), "w") as f:
            f.write(json.dumps(dict(rec, maintenance_date=f"{day}T00:00:00Z")) + "\n")
        start_ingest(spark, land, f"{out}/t", checkpoint=ck).awaitTermination(120)
    assert spark.read.parquet(f"{out}/t").count() == 3


def test_entry_contract(spark):
    import __spark_entry__ as E
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    from upkeep.plans.catalog import QUERIES
    assert set(QUERIES) <= set(qs)
    assert not any(n.startswith("op") or "pipeline" in n for n in QUERIES)
    df = E.entry(spark)
    assert df.count() > 0 and "maintenance_needed" in df.columns
