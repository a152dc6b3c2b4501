"""Bootstrap of the AUC, bounded curves, samples, folds and tuning against plain Python."""
import random
from collections import Counter

from pyspark.sql import functions as F

from upkeep.operators import evaluate as EV
from upkeep.operators import models as MD


def _rows(n=200, seed=3):
    r = random.Random(seed)
    return [(k, r.random() < 0.4, round(r.random(), 2), k % 2) for k in range(n)]


def _df(spark, rows):
    return spark.createDataFrame(rows, "id long, label boolean, score double, prediction int")


def test_auc_replicates_against_pairs(spark):
    rows = _rows()
    df = _df(spark, rows)
    drawn = EV._drawn(df, F.col("id"), 8, 42, F.col("id")).collect()
    weight = {(r["id"], 4 * r["_k"] + j): r[f"_w{j}"] for r in drawn for j in range(4)}
    for max_rows in (None, 15):
        got = {r["replicate"]: r for r in EV.bootstrap_auc(df, F.col("id"), replicates=8, max_rows=max_rows).collect()}
        assert sorted(got) == list(range(8))
        for k, r in got.items():
            pos, neg = ([(s, weight[i, k]) for i, y, s, _ in rows if y == side and weight[i, k]] for side in (True, False))
            pairs = sum(wp * wn * ((sp > sn) + 0.5 * (sp == sn)) for sp, wp in pos for sn, wn in neg)
            assert (r["pos"], r["neg"]) == (sum(w for _, w in pos), sum(w for _, w in neg))
            assert abs(r["roc_auc"] - pairs / (r["pos"] * r["neg"])) < 1e-12


def test_auc_weights_are_those_of_f1(spark):
    df = _df(spark, _rows())
    f1 = {r["replicate"]: r["tp"] + r["fn"] for r in EV.bootstrap_f1(df, F.col("id"), replicates=12).collect()}
    assert f1 == {r["replicate"]: r["pos"] for r in EV.bootstrap_auc(df, F.col("id"), replicates=12).collect()}


def test_auc_of_odd_rows(spark):
    rows = [(1, True, 0.5, 1), (2, True, None, 1), (3, None, 0.2, 0), (4, True, 0.7, 1)]
    got = EV.bootstrap_auc(_df(spark, rows), F.col("id"), replicates=5).collect()
    assert all(r["roc_auc"] == 0.0 and r["neg"] == 0 for r in got)
    assert EV.bootstrap_auc(_df(spark, []), F.col("id"), replicates=5).count() == 0


def test_binned_curve_is_exact_at_its_edges(spark):
    rows = [*_rows(), (900, True, 1.0, 1), (901, False, 0.0, 0), (902, True, 0.29, 1), (903, True, None, 1), (904, True, 1.5, 1), (905, False, -1.0, 0)]
    some = [(y, s) for _, y, s, _ in rows if s is not None]
    for r in EV.binned_curve(_df(spark, rows), bins=100).collect():
        reach = [y for y, s in some if s >= r["threshold"] or r["threshold"] == 0]
        assert (r["tp"], r["fp"]) == (sum(reach), len(reach) - sum(reach)), r
    assert EV.binned_curve(_df(spark, rows).withColumn("model", F.col("id") % 2), bins=10).count() == 20


def test_samples_and_folds_do_not_depend_on_partitioning(spark):
    df = _df(spark, _rows(500))
    assert [r["id"] for r in EV.sample_rows(df, 3, ["id"]).collect()] == [0, 1, 2]
    a, b = (sorted(r["id"] for r in EV.sample_rows(x, 7, ["id"], seed=5).collect()) for x in (df, df.repartition(9)))
    assert a == b and a != list(range(7)) and len(a) == 7
    folds = Counter(r["f"] for r in df.select(EV.hash_fold(F.col("id"), 15).alias("f")).collect())
    assert set(folds) == set(range(15))


def test_axes_and_random_search():
    assert [len(MD.grid_points(n)) for n in ("random_forest", "gbt_depthwise", "gbt_leafwise")] == [72, 729, 1458]
    few = MD.grid_points("gbt_leafwise", points=5)
    assert few == MD.grid_points("gbt_leafwise", points=5) and len({str(x) for x in few}) == 5
    assert all(x in MD.grid_points("gbt_leafwise") for x in few)


def test_tuning_keeps_folds_apart_and_chooses_by_mean(spark):
    r = random.Random(1)
    rows = [(k, float(y), y + r.gauss(0, 0.3), r.random()) for k in range(300) for y in [int(r.random() < 0.2)]]
    df = spark.createDataFrame(rows, "id long, label double, x double, noise double")
    tuned = MD.tune(df, ["x", "noise"], F.col("id"), names=("random_forest", "gbt_depthwise"), points=2, trees=(2,), tune_folds=2, cv_folds=3)
    folds = tuned.folds.collect()
    assert len(folds) == 6
    size = Counter(r["f"] % 3 for r in df.select(EV.hash_fold(F.col("id"), 6).alias("f")).collect())
    for f in folds:  # every row is predicted once, by the model that has not seen it
        assert f["tp"] + f["fp"] + f["tn"] + f["fn"] == size[f["fold"]]
    table = {r["model"]: r for r in tuned.table.collect()}
    for name, t in table.items():
        own = [f["f1_score"] for f in folds if f["model"] == name]
        assert abs(t["cv_mean"] - sum(own) / 3) < 1e-12
    assert max(table, key=lambda n: table[n]["cv_mean"]) == tuned.best and [n for n, t in table.items() if t["chosen"]] == [tuned.best]
    weights = {r["label"]: r for r in MD.with_weightings(df).select("label", "weight_balanced", "weight_none", "weight_two").distinct().collect()}
    n1 = sum(y for _, y, _, _ in rows)
    assert abs(weights[1.0]["weight_balanced"] - 300 / (2 * n1)) < 1e-12 and weights[1.0]["weight_two"] == 2 and weights[0.0]["weight_two"] == 1


def test_the_tuned_query_searches_the_whole_grid(spark, monkeypatch):
    """No parameter of the query bounds the points, the numbers of trees or the folds."""
    import inspect

    from upkeep import schema as S
    from upkeep.plans import catalog as C

    class Asked(Exception):
        pass

    signature = inspect.signature(MD.tune)

    def tune(*args, **kw):
        bound = signature.bind(*args, **kw)
        bound.apply_defaults()
        raise Asked(bound.arguments)

    monkeypatch.setattr(C, "_train_test", lambda *_: (None, None, ["x"]))
    monkeypatch.setattr(MD, "tune", tune)
    try:
        C.q_tuned_models(spark, "")
    except Asked as error:
        asked = error.args[0]
    assert [len(MD.grid_points(n, asked["points"], asked["trees"])) for n in asked["names"]] == [72, 729, 1458]
    assert asked["trees"] == S.TREES == (100, 200, 300)
    assert (asked["tune_folds"], asked["cv_folds"]) == (3, 5)
