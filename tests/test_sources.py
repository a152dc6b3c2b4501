import json
import os
import tempfile

from pyspark.sql import functions as F

from upkeep.operators import quality as Q
from upkeep.sources import extract as EX
from upkeep.sources import readers as RD

REC = {"building_id": 7, "building_type": "residential", "asset_type": "elevator", "maintenance_type": "preventive",
       "maintenance_date": "2024-03-01T10:00:00Z", "failure_reported": False, "downtime_days": 0,
       "maintenance_cost": 120.5, "technician_id": 3, "period_days": 30, "city": "Tirana", "country": "Albania",
       "building_area": 2500.0, "building_floors": 6}


def _write(obj):
    d = tempfile.mkdtemp(prefix="upkeep-src-", dir="/tmp")
    p = os.path.join(d, "in.json")
    with open(p, "w") as f:
        json.dump(obj, f)
    return p


def test_json_shapes(spark):
    shapes = [[REC, dict(REC, building_id=8)], {"data": [REC]}, REC,
              {"metadata": {"total_records": 500}, "maintenance_records": [dict(REC, record_id=1, severity="low")]}]
    counts = [RD.read_json(spark, _write(s)).count() for s in shapes]
    assert counts == [2, 1, 1, 1]
    row = RD.read_json(spark, _write(REC)).first()
    assert row.building_id == 7 and row.failure_reported is False
    assert str(row.maintenance_date) == "2024-03-01 10:00:00"


def test_export_document_drops_descriptive_fields(spark):
    doc = {"metadata": {"total_records": 500},
           "buildings": [{"building_id": 7, "building_name": "A"}],
           "technicians": [{"technician_id": 3, "name": "T", "specializations": ["hvac", "lift"]}],
           "maintenance_records": [dict(REC, record_id=1, technician_name="T", work_description="x")]}
    p = _write(doc)
    df = RD.read_export_document(spark, p)
    assert "technician_name" not in df.columns and df.count() == 1
    dims = RD.read_document_dimensions(spark, p)
    assert dims["technicians"].first().specializations == ["hvac", "lift"]
    empty = _write({"metadata": {}, "maintenance_records": []})
    try:
        RD.read_export_document(spark, empty)
        raise AssertionError("expected ValueError")
    except ValueError:
        pass


def test_csv_coercion_nulls_bad_cells(spark):
    d = tempfile.mkdtemp(prefix="upkeep-csv-", dir="/tmp")
    p = os.path.join(d, "r.csv")
    cols = list(REC)
    with open(p, "w") as f:
        f.write(",".join(cols) + "\n")
        f.write(",".join(str(REC[c]) for c in cols) + "\n")
        bad = dict(REC, building_floors="1.5", maintenance_cost="abc", failure_reported="False")
        f.write(",".join(str(bad[c]) for c in cols) + "\n")
    rows = RD.read_records(spark, "csv", p).orderBy(F.col("building_floors").desc_nulls_last()).collect()
    assert rows[0].building_floors == 6 and rows[1].building_floors is None
    assert rows[1].maintenance_cost is None and rows[1].failure_reported is False


def test_csv_columns_are_read_by_name(spark, tmp_path):
    cols = list(reversed(list(REC)))
    a = tmp_path / "a"
    a.mkdir()
    (a / "x.csv").write_text(",".join(["extra", *cols]) + "\n" + ",".join(["?", *[str(REC[c]) for c in cols]]) + "\n")
    row = RD.read_csv(spark, str(a)).first()
    assert row.building_id == int(REC["building_id"]) and row.asset_type == REC["asset_type"] and row.city == REC["city"]
    assert "extra" not in row.asDict()
    fewer = [c for c in cols if c not in ("technician_id", "downtime_days")]
    b = tmp_path / "b"
    b.mkdir()
    (b / "x.csv").write_text(",".join(fewer) + "\n" + ",".join(str(REC[c]) for c in fewer) + "\n")
    row = RD.read_csv(spark, str(b)).first()
    assert row.technician_id is None and row.downtime_days == 0 and row.city == REC["city"]
    (b / "y.csv").write_text("city\nTirana\n")
    try:
        RD.read_csv(spark, str(b)).collect()
        raise AssertionError("expected a failure: the headers disagree")
    except AssertionError:
        raise
    except Exception:  # noqa: BLE001
        pass


def test_unknown_source(spark):
    try:
        RD.read_records(spark, "xml", "/nowhere")
        raise AssertionError("expected ValueError")
    except ValueError:
        pass


def test_required_columns(make_records):
    df = make_records([]).drop("downtime_days", "technician_id")
    out = Q.ensure_required_columns(df)
    assert {"downtime_days", "technician_id"} <= set(out.columns)
    try:
        Q.ensure_required_columns(df.drop("asset_type"))
        raise AssertionError("expected ValueError")
    except ValueError:
        pass


def test_extract_report_flag_and_first_resident(spark):
    from datetime import datetime as dt
    t = {
        "buildings": spark.createDataFrame([(1, "R", 100.0, 2, 1, 1, None), (2, "R", 50.0, 1, 1, 1, dt(2020, 1, 1))],
                                           "id long, type string, area double, number_of_floors long, city_id long, country_id long, deleted_at timestamp"),
        "building_types": spark.createDataFrame([("R", "residential")], "code string, name string"),
        "cities": spark.createDataFrame([(1, "Tirana")], "id long, name string"),
        "countries": spark.createDataFrame([(1, "Albania")], "id long, name string"),
        "building_service_technician": spark.createDataFrame([(1, 10, 5, 30), (2, 10, 5, 30)],
                                                             "building_id long, service_id long, user_id long, period_days long"),
        "services": spark.createDataFrame([(10, "elevator", None)], "id long, title string, deleted_at timestamp"),
        "recurring_services": spark.createDataFrame([(10, 1, dt(2024, 3, 1)), (10, 1, dt(2024, 1, 1)), (10, 1, None)],
                                                    "service_id long, building_id long, checked_date timestamp"),
        "reports": spark.createDataFrame([(1, 1, dt(2024, 2, 1))], "id long, building_id long, created_at timestamp"),
        "building_resident": spark.createDataFrame([(3, 1), (2, 1)], "resident_id long, building_id long"),
        "resident_invoice": spark.createDataFrame([(2, 70.0), (2, 75.0), (3, 90.0)], "resident_id long, value double"),
    }
    rows = EX.sorted_extract(EX.extract_records(t)).collect()
    assert [(r.maintenance_date.month, r.failure_reported, r.maintenance_cost) for r in rows] == \
        [(1, True, 70.0), (3, True, 70.0)]
    win = {r.maintenance_date.month: r.failure_reported for r in EX.extract_records(t, window_days=10).collect()}
    assert win == {1: False, 3: True}
