from pyspark.sql import functions as F

from upkeep.operators import encode as EN
from upkeep.schema import RECORD_SCHEMA
from tests.conftest import rec


def test_unseen_category_and_onehot(make_records, spark):
    train = make_records([rec(asset_type="A", city=f"c{i}") for i in range(12)] + [rec(asset_type="B")])
    enc = EN.fit(train)
    assert "asset_type" in enc.onehot and "city" in enc.label_columns
    new = make_records([rec(asset_type="Z", city="nowhere")])
    out = EN.apply_encoding(new, enc).first()
    assert out["city_encoded"] == -1
    assert out["asset_type_A"] == 0.0 and out["asset_type_B"] == 0.0


def test_label_codes_sorted_and_distributed(spark):
    df = spark.createDataFrame([(str(i),) for i in range(40)], "technician_id string")
    a = {r.value: r.code for r in EN.fit_label_vocab(df, ["technician_id"]).collect()}
    b = {r.value: r.code for r in EN.fit_label_vocab(df, ["technician_id"], partitions=7).collect()}
    expected = {v: i for i, v in enumerate(sorted(str(i) for i in range(40)))}
    assert a == expected and b == expected


def test_zero_std_scales_to_zero(make_records):
    df = make_records([rec(area=500.0, date=f"2024-01-0{i} 00:00:00") for i in range(1, 4)])
    sc = {r.feature: (r.mean, r.scale) for r in EN.fit_scaler(df, ["building_area"]).collect()}
    assert sc["building_area"] == (500.0, 1.0)
    enc = EN.FittedEncoding({}, [], None, EN.fit_scaler(df, ["building_area"]), ["building_area"])
    assert {r.building_area for r in EN.apply_scaler(df, enc).collect()} == {0.0}
