import itertools
import random

from pyspark.sql import functions as F

from upkeep.operators import evaluate as EV


def _scored(spark, n=300, seed=3):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        y = rnd.random() < 0.4
        s = round(min(1.0, max(0.0, rnd.gauss(0.6 if y else 0.4, 0.2))), 2)
        rows.append((str(i), y, s, int(s >= 0.5)))
    return spark.createDataFrame(rows, "id string, label boolean, score double, prediction int"), rows


def test_zero_division_precision(spark):
    df = spark.createDataFrame([(True, 0.1, 0), (False, 0.2, 0)], "label boolean, score double, prediction int")
    m = EV.classification_metrics(df).first()
    assert m.precision == 0.0 and m.f1_score == 0.0 and m.recall == 0.0


def test_auc_matches_brute_force(spark):
    df, rows = _scored(spark)
    pos = [s for _, y, s, _ in rows if y]
    neg = [s for _, y, s, _ in rows if not y]
    brute = sum(1.0 if p > q else 0.5 if p == q else 0.0 for p, q in itertools.product(pos, neg)) / (len(pos) * len(neg))
    got = EV.auc_ap(df).first().roc_auc
    assert abs(got - brute) < 1e-12


def test_curves_invariant_to_partitioning(spark):
    df, _ = _scored(spark)
    a = sorted(tuple(r) for r in EV.roc_points(df).collect())
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    b = sorted(tuple(r) for r in EV.roc_points(df.repartition(7)).collect())
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert a == b


def test_threshold_sweep_and_best(spark):
    df, rows = _scored(spark)
    sweep = {round(r.threshold, 1): r for r in EV.threshold_sweep(df).collect()}
    tp = sum(1 for _, y, s, _ in rows if y and s >= 0.5)
    fp = sum(1 for _, y, s, _ in rows if not y and s >= 0.5)
    assert abs(sweep[0.5].precision - tp / (tp + fp)) < 1e-12
    best = EV.best_threshold(EV.threshold_sweep(df)).first()
    assert best.optimal_f1_score == max(r.f1_score for r in sweep.values())


def test_stratified_split_exact(spark):
    df, rows = _scored(spark, n=500)
    out = EV.stratified_split(df, F.col("id")).groupBy("label").agg(
        F.count_if("is_test").alias("t"), F.count(F.lit(1)).alias("n")).collect()
    for r in out:
        assert r.t == round(r.n * 0.2)
    # hot classes split into segments give the same membership
    a = {r.id for r in EV.stratified_split(df, F.col("id")).filter("is_test").collect()}
    assert len(a) == sum(r.t for r in out)


def test_bootstrap_deterministic(spark):
    df, _ = _scored(spark)
    a = [tuple(r) for r in EV.bootstrap_f1(df, F.col("id"), replicates=10).orderBy("replicate").collect()]
    b = [tuple(r) for r in EV.bootstrap_f1(df.repartition(5), F.col("id"), replicates=10).orderBy("replicate").collect()]
    assert a == b and len(a) == 10


def test_hot_path_curves_and_split_match(spark):
    """Forcing segmentation (tiny max_rows) leaves curves, AUC and the split unchanged."""
    df, _ = _scored(spark, n=400)
    a = sorted(tuple(r) for r in EV.roc_points(df).collect())
    b = sorted(tuple(r) for r in EV.roc_points(df, max_rows=7).collect())
    assert a == b
    assert EV.auc_ap(df).first() == EV.auc_ap(df, max_rows=7).first()
    s1 = {r.id for r in EV.stratified_split(df, F.col("id")).filter("is_test").collect()}
    s2 = {r.id for r in EV.stratified_split(df, F.col("id"), max_rows=25).filter("is_test").collect()}
    assert s1 == s2
