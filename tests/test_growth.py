"""Steps whose shuffled, stored or computed volume must grow no faster than the input."""

import os

import pytest
from pyspark.sql import functions as F

from upkeep.operators.stats import exact_median
from upkeep.sources.adapters import records_from_tables

SF = "/root/testdata/sf0.001"


@pytest.fixture
def joins_shuffle(spark):
    """No broadcast by size and no plan changes at run time, as with tables too large for them."""
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")
    before = {n: spark.conf.get(n) for n in names}
    spark.conf.set(names[0], "-1")
    spark.conf.set(names[1], "false")
    yield
    for n, v in before.items():
        spark.conf.set(n, v)


def plan_lines(df) -> list[str]:
    return df._jdf.queryExecution().executedPlan().toString().splitlines()


def test_line_items_are_not_shuffled_for_the_customers(spark, joins_shuffle):
    lines = plan_lines(records_from_tables(spark, SF, dirty=True))
    (at,) = [i for i, line in enumerate(lines) if "hashpartitioning(o_custkey" in line]
    depth = lines[at].index("Exchange")
    below = []
    for line in lines[at + 1:]:
        if len(line) - len(line.lstrip(" :+-*()0123456789")) <= depth:
            break
        below.append(line)
    assert any("orders.parquet" in line for line in below)
    assert not any("lineitem.parquet" in line for line in below)


def test_median_reads_its_rows_once(spark, tmp_path):
    path = os.fspath(tmp_path / "rows")
    spark.range(101).select((F.col("id") % 2).alias("k"), F.col("id").cast("double").alias("v")).write.parquet(path)
    out = exact_median(spark.read.parquet(path), ["k"], "v")
    assert not any("rows" in f for f in out.inputFiles())   # the counts are stored, nothing reads the rows again
    assert {r["k"]: r["median"] for r in out.collect()} == {0: 50.0, 1: 50.0}


def test_rounding_equals_the_decimal_one(spark):
    from upkeep.functions.expressions import round_half_up

    hard = [0.0, -0.0, 0.5, 1.5, -0.5, 2.5e-6, 0.0000005, -0.0000005, 1.0000005, 1234.5678905, -1e-9, 1e9 + 0.1234565, 1e17, -3e300, float("inf"), float("nan"), None]
    hard += [(-1) ** i * (i * 7919 % 100003) / 2 ** (i % 40) for i in range(4000)] + [(2 * i + 1) / 2e6 for i in range(2000)] + [i / 10 for i in range(200)]
    df = spark.createDataFrame([(x,) for x in hard], "x double")
    for digits in (0, 4, 6):
        same = df.select(round_half_up(F.col("x"), digits).alias("a"), F.round("x", digits).alias("b")).filter(~F.col("a").cast("string").eqNullSafe(F.col("b").cast("string")))
        assert same.collect() == []


def test_split_shuffles_no_rows(spark, joins_shuffle):
    from upkeep.operators import evaluate as EV

    df = spark.range(3000).select("id", (F.col("id") % 3 == 0).alias("label"), F.md5(F.col("id").cast("string")).alias("wide"))
    out = EV.stratified_split(df, F.col("id"))
    assert not any("Exchange hashpartitioning" in line for line in plan_lines(out))
    ranks = [(r.label, r.is_test) for r in out.collect()]
    assert ranks.count((True, True)) == 200 and ranks.count((False, True)) == 400


def test_split_counts_hold_when_rows_share_their_identity(spark):
    from upkeep.operators import evaluate as EV

    df = spark.range(1000).select((F.col("id") % 2).alias("label"), (F.col("id") % 5).alias("same")).unionByName(
        spark.range(7).select(F.lit(None).cast("long").alias("label"), F.col("id").alias("same")))
    for row_id in (F.lit("x"), F.col("same"), F.lit(None).cast("string")):
        out = EV.stratified_split(df, row_id).groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.count_if("is_test").alias("t")).collect()
        assert {r.label: (r.n, r.t) for r in out} == {0: (500, 100), 1: (500, 100)}


def test_cleaning_shuffles_whole_rows_only_where_needed(spark, joins_shuffle):
    from upkeep.operators import quality as Q

    df = records_from_tables(spark, SF, dirty=True)
    tie = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    stored = Q.clean(df, as_of="2001-12-01", tie=tie)
    plain = Q.clean(df, as_of="2001-12-01", tie=tie, checkpoint=False)
    assert not any("Exchange hashpartitioning" in line for line in plan_lines(stored.finished))
    columns = sorted(stored.finished.columns)
    assert sorted(map(str, stored.finished.select(columns).collect())) == sorted(map(str, plain.finished.select(columns).collect()))


def test_duplicates_found_by_hash_equal_those_of_the_whole_rows(spark):
    from upkeep.operators import quality as Q

    rows = spark.range(200).select((F.col("id") % 40).alias("building_id"), F.when(F.col("id") % 3 != 0, F.lit("a")).alias("asset_type"), "id")
    key = ["building_id", "asset_type"]
    a, b = (f(rows, key=key, tie=["id"], copies="n").select("building_id", "asset_type", "id", "n") for f in (Q.drop_stored_duplicates, Q.drop_duplicates_first))
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_short_vocabularies_need_no_join(spark):
    from upkeep.operators import encode as EN

    rows = spark.createDataFrame([(f"c{i % 30}" if i % 7 else None, f"s{i % 3}") for i in range(90)], "city string, maintenance_season string")
    enc = EN.fit(rows, categorical=["city"], engineered=["maintenance_season"])
    assert enc.label_columns == ["city", "maintenance_season"]
    new = rows.unionByName(spark.createDataFrame([("unseen", None)], rows.schema))
    out = EN.apply_encoding(new, enc)
    assert not any("Join" in line for line in plan_lines(out))
    enc.vocab_sizes = {}   # unknown sizes: by joins
    joined = EN.apply_encoding(new, enc)
    assert out.columns == joined.columns
    assert sorted(map(str, out.collect())) == sorted(map(str, joined.collect()))


def test_export_documents_hold_a_bounded_number_of_records(spark):
    """Documents of up to 500 records, every record in one, the distinct members of each document collected as rows are grouped and not compared in pairs afterwards."""
    import json

    from upkeep.plans import catalog as C

    records = spark.range(1201).select((F.col("id") % 7).alias("building_id"), F.col("id").cast("string").alias("city"))
    docs = C._as_documents(records, [F.array(F.to_json(F.struct("records", "buildings")))], {"buildings": F.struct("building_id")})
    read = [json.loads(r["value"]) for r in docs.collect()]
    assert max(len(d["records"]) for d in read) <= 500
    assert sorted(int(r["city"]) for d in read for r in d["records"]) == list(range(1201))
    for d in read:
        assert sorted(b["building_id"] for b in d["buildings"]) == sorted({r["building_id"] for r in d["records"]})


def test_scores_do_not_store_all_features(spark, monkeypatch):
    """The scored set takes the features it needs as they are made; the stored table of all of them is not written for it."""
    from upkeep.plans import catalog as C

    monkeypatch.setattr(C, "_STAGES", {})
    stored = []
    write = C.materialize
    monkeypatch.setattr(C, "materialize", lambda df, *a: stored.append(df.columns) or write(df, *a))
    assert C.q_eval_metrics(spark, SF).first()["tp"] > 0
    assert len(stored) == 1 and "cumulative_maintenance_cost" not in stored[0]


def test_stored_tables_are_compressed_and_leave_the_session_as_it_was(spark):
    from upkeep.session import WIDE, materialize

    limit = spark.conf.get("spark.sql.codegen.hugeMethodLimit")
    wide = materialize(spark.range(10).select(*[(F.col("id") + k).alias(f"c{k}") for k in range(WIDE)]))
    assert all(".zstd." in f for f in wide.inputFiles())
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == limit
    assert sorted(r["c1"] for r in wide.collect()) == list(range(1, 11))


def test_tuning_fits_each_point_and_fold_once(spark, monkeypatch):
    """No model is fitted beyond those of the folds and the chosen one, and no fit assembles the columns again."""
    from pyspark.ml.classification import RandomForestClassifier

    from upkeep.operators import models as MD

    fits, fit = [], RandomForestClassifier._fit
    monkeypatch.setattr(RandomForestClassifier, "_fit", lambda self, df: fits.append(df.columns) or fit(self, df))
    df = spark.range(200).select("id", (F.col("id") % 3 == 0).cast("double").alias("label"), (F.col("id") % 7).cast("double").alias("x"), F.rand(3).alias("y"))
    tuned = MD.tune(df, ["x", "y"], F.col("id"), names=("random_forest",), points=2, trees=(2,), tune_folds=2, cv_folds=3)
    assert len(fits) == 2 * 2 + 3 + 1 and not any("x" in columns for columns in fits)
    assert tuned.model.transform(df).count() == 200


def shuffles(spark) -> set[str]:
    """Ids of the shuffles that have files."""
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {f.getName().split("_")[1] for f in (files.apply(i) for i in range(files.size())) if f.getName().startswith("shuffle_")}


def left_over(spark, before: set[str]) -> set[str]:
    """New shuffles that still have files; they are deleted in the background."""
    import time

    for _ in range(50):
        if not shuffles(spark) - before:
            break
        time.sleep(0.2)
    return shuffles(spark) - before


def test_a_stored_table_leaves_no_shuffled_files(spark):
    from upkeep.session import materialize

    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    setting, before = spark.conf.get(key), shuffles(spark)
    grouped = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    stored = materialize(grouped)
    assert left_over(spark, before) == set() and spark.conf.get(key) == setting
    assert sum(r["n"] for r in stored.collect()) == 1000 and grouped.count() == 7   # the plan itself can run again


def test_extract_shuffles_checks_without_their_buildings(spark, joins_shuffle):
    from upkeep.plans import catalog as C

    before = shuffles(spark)
    out = C.q_extract_window(spark, SF)
    assert left_over(spark, before) == set()
    lines = [line for line in plan_lines(out) if "Exchange hashpartitioning" in line]
    # checks and flags by building and time, then checks and buildings by building
    assert len(lines) == 4 and out.count() > 0


def test_json_lines_are_stored_compressed(spark):
    from upkeep.plans import catalog as C

    out = C.q_json_roundtrip(spark, SF)
    assert out.inputFiles() and all(f.endswith(".json.gz") for f in out.inputFiles())
    rows = records_from_tables(spark, SF, keep_tie=False)
    assert out.columns == rows.columns and out.exceptAll(rows).isEmpty() and rows.exceptAll(out).isEmpty()


def test_an_append_to_the_history_leaves_no_shuffled_files(spark, tmp_path):
    from upkeep.sources import history as H

    path, before = os.fspath(tmp_path / "history"), shuffles(spark)
    scored = spark.range(50).select((F.col("id") % 5).alias("building_id"), F.lit("a").alias("asset_type"), F.lit("2001-05-05 00:00:00").cast("timestamp").alias("prediction_date"))
    for run in ("a", "a", "b"):
        H.append_predictions(scored, path, buckets=2, run_id=run)
    assert left_over(spark, before) == set()
    stored = spark.read.parquet(path)
    assert stored.count() == 100 and all(".zstd." in f for f in stored.inputFiles())


def test_the_history_stores_the_scores_once(spark, monkeypatch):
    from upkeep.plans import catalog as C

    monkeypatch.setattr(C, "_STAGES", {})
    stored = []
    write = C.materialize
    monkeypatch.setattr(C, "materialize", lambda df, *a: stored.append(df.columns) or write(df, *a))
    assert C.q_prediction_history(spark, SF).count() > 0
    assert len(stored) == 1


def test_features_made_for_the_split_do_not_stay_beside_the_fit(spark, monkeypatch):
    from upkeep.plans import catalog as C
    from upkeep.session import temporary_tables

    def there(paths):
        return [p for p in paths if os.path.exists(p.removeprefix("file:"))]

    monkeypatch.setattr(C, "_STAGES", {})
    monkeypatch.setattr(C, "FEATURE_PLACE", {})
    with temporary_tables(spark) as paths:
        train, _, cols = C._train_test(spark, SF)
        wide = [p for p in there(paths) if len(spark.read.parquet(p).columns) > 40]
        assert len(wide) == 1 and set(cols) <= set(spark.read.parquet(wide[0]).columns)   # the split
        assert train.count() > 0
        again = C._feature_table(spark, SF)   # made again for who asks for them
        C._STAGES.pop((spark.sparkContext.applicationId, SF, "split"))
        assert C._train_test(spark, SF)[0].exceptAll(train).isEmpty() and again.count() > 0


def test_families_predict_rows_read_once(spark, tmp_path, monkeypatch):
    """The rows of ``predict`` for each model from one scan, of which the comparison stores what it compares."""
    from upkeep.operators import models as MD
    from upkeep.plans import catalog as C

    path = os.fspath(tmp_path / "rows")
    spark.range(300).select("id", (F.col("id") % 3 == 0).cast("double").alias("label"), (F.col("id") % 7).cast("double").alias("x"), F.rand(3).alias("y")).write.parquet(path)
    df, stored = spark.read.parquet(path), []
    monkeypatch.setattr(C, "_train_test", lambda *_: (df, df, ["x", "y"]))
    monkeypatch.setattr(C, "FAMILY_PARAMS", {"random_forest": {"numTrees": 3, "maxDepth": 3}, "gbt_depthwise": {"maxIter": 2, "maxDepth": 2}})
    monkeypatch.setattr(C, "materialize", lambda df: stored.append(df) or df)
    assert C.q_model_families(spark, "").count() == 10
    (scored,) = stored
    assert sorted(scored.columns) == ["label", "model", "prediction", "score"]
    assert sum("FileScan" in line for line in plan_lines(scored)) == 1
    models = {n: MD.fit_fixed(df, ["x", "y"], n, seed=C.S.SPLIT_SEED, **p) for n, p in C.FAMILY_PARAMS.items()}
    each = MD.predict_each(models, df, keep=["id"])
    for n, m in models.items():
        one = MD.predict(m, df, keep=["id"], model_name=n).select(*each.columns)
        assert sorted(map(str, one.collect())) == sorted(map(str, each.filter(F.col("model") == n).collect()))
