"""Classification evaluation as distributed aggregates.

Input: a scored table with a boolean/0-1 ``label`` column, a probability
``score`` and a 0/1 ``prediction`` (optionally a ``model`` column to
evaluate several models in one pass).  Every metric is one partial
aggregate followed by arithmetic on a handful of rows; curves use the
segmented scan over distinct scores, so no step funnels rows to one task.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from upkeep import schema as S
from upkeep.operators.scan import ordered_scan, segment
from upkeep.session import materialize

MODEL = "model"


def _keys(df: DataFrame) -> list:
    return [MODEL] if MODEL in df.columns else []


def _ratio(num: Column, den: Column) -> Column:
    """num / den with zero_division = 0."""
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))


def _pos(df_label: str = "label") -> Column:
    return F.col(df_label).cast("boolean")


def confusion_counts(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    y, p = _pos(label), F.col(prediction).cast("int") == 1
    return df.groupBy(*_keys(df)).agg(
        F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"),
        F.count_if(~y & ~p).alias("tn"), F.count_if(y & ~p).alias("fn"))


def metrics_from_counts(c: DataFrame) -> DataFrame:
    tp, fp, tn, fn = (F.col(x) for x in ("tp", "fp", "tn", "fn"))
    precision = _ratio(tp, tp + fp)
    recall = _ratio(tp, tp + fn)
    return c.select(
        "*",
        _ratio(tp + tn, tp + fp + tn + fn).alias("accuracy"),
        precision.alias("precision"), recall.alias("recall"),
        _ratio(2 * tp, 2 * tp + fp + fn).alias("f1_score"),
        _ratio(tn, tn + fp).alias("specificity"), recall.alias("sensitivity"),
        _ratio(fp, fp + tn).alias("false_positive_rate"), _ratio(fn, fn + tp).alias("false_negative_rate"))


def classification_metrics(df: DataFrame, **kw) -> DataFrame:
    """Confusion counts and derived rates per model."""
    return metrics_from_counts(confusion_counts(df, **kw))


def classification_report(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Per-class precision/recall/F1/support plus accuracy, macro and weighted averages."""
    m = classification_metrics(df, label=label, prediction=prediction)
    keys = _keys(df)
    tp, fp, tn, fn = (F.col(x) for x in ("tp", "fp", "tn", "fn"))
    # class 0 swaps the roles of positives and negatives
    c1 = m.select(*keys, F.lit("1").alias("class"), _ratio(tp, tp + fp).alias("precision"),
                  _ratio(tp, tp + fn).alias("recall"), _ratio(2 * tp, 2 * tp + fp + fn).alias("f1_score"),
                  (tp + fn).cast("double").alias("support"))
    c0 = m.select(*keys, F.lit("0").alias("class"), _ratio(tn, tn + fn).alias("precision"),
                  _ratio(tn, tn + fp).alias("recall"), _ratio(2 * tn, 2 * tn + fn + fp).alias("f1_score"),
                  (tn + fp).cast("double").alias("support"))
    classes = c0.unionByName(c1)
    agg = classes.groupBy(*keys).agg(
        F.avg("precision").alias("mp"), F.avg("recall").alias("mr"), F.avg("f1_score").alias("mf"),
        (F.sum(F.col("precision") * F.col("support")) / F.sum("support")).alias("wp"),
        (F.sum(F.col("recall") * F.col("support")) / F.sum("support")).alias("wr"),
        (F.sum(F.col("f1_score") * F.col("support")) / F.sum("support")).alias("wf"),
        F.sum("support").alias("n"))
    macro = agg.select(*keys, F.lit("macro avg").alias("class"), F.col("mp").alias("precision"),
                       F.col("mr").alias("recall"), F.col("mf").alias("f1_score"), F.col("n").alias("support"))
    weighted = agg.select(*keys, F.lit("weighted avg").alias("class"), F.col("wp").alias("precision"),
                          F.col("wr").alias("recall"), F.col("wf").alias("f1_score"), F.col("n").alias("support"))
    acc = m.select(*keys, F.lit("accuracy").alias("class"), F.col("accuracy").alias("precision"),
                   F.col("accuracy").alias("recall"), F.col("accuracy").alias("f1_score"),
                   (tp + fp + tn + fn).cast("double").alias("support"))
    return reduce(DataFrame.unionByName, [classes, acc, macro, weighted])


def threshold_sweep(df: DataFrame, thresholds=S.THRESHOLD_GRID, label: str = "label",
                    score: str = "score") -> DataFrame:
    """precision/recall/F1 at each threshold (prediction = score >= t).

    One pass with conditional counts per threshold - no cross join.
    """
    y, s = _pos(label), F.col(score)
    aggs = [F.count_if(y).alias("pos")]
    for i, t in enumerate(thresholds):
        aggs += [F.count_if(y & (s >= t)).alias(f"tp{i}"), F.count_if(~y & (s >= t)).alias(f"fp{i}")]
    wide = df.groupBy(*_keys(df)).agg(*aggs)
    keys = _keys(df)
    stack = ", ".join(f"CAST({t} AS DOUBLE), tp{i}, fp{i}" for i, t in enumerate(thresholds))
    long = wide.selectExpr(*keys, "pos", f"stack({len(thresholds)}, {stack}) AS (threshold, tp, fp)")
    tp, fp, pos = F.col("tp"), F.col("fp"), F.col("pos")
    return long.select(*keys, "threshold", _ratio(tp, tp + fp).alias("precision"),
                       _ratio(tp, pos).alias("recall"), _ratio(2 * tp, tp + fp + pos).alias("f1_score"))


def best_threshold(sweep: DataFrame) -> DataFrame:
    """First threshold with the highest F1 (ties -> lowest threshold)."""
    keys = [MODEL] if MODEL in sweep.columns else []
    best = sweep.groupBy(*keys).agg(
        F.max(F.struct(F.col("f1_score"), (-F.col("threshold")).alias("neg_t"))).alias("b"))
    return best.select(*keys, (-F.col("b.neg_t")).alias("optimal_threshold"),
                       F.col("b.f1_score").alias("optimal_f1_score"))


def error_patterns(df: DataFrame, features: list, label: str = "label",
                   prediction: str = "prediction", top_k: int = 5) -> DataFrame:
    """Feature means among false positives and false negatives, ranked.

    Output: (error_kind, feature, mean, errors, rank); rank <= top_k marks the
    largest means (the top-k report).
    """
    y, p = _pos(label), F.col(prediction).cast("int") == 1
    kind = F.when(~y & p, F.lit("false_positive")).when(y & ~p, F.lit("false_negative"))
    errs = df.withColumn("error_kind", kind).filter(F.col("error_kind").isNotNull())
    keys = _keys(df)
    wide = errs.groupBy(*keys, "error_kind").agg(
        F.count(F.lit(1)).alias("errors"), *[F.avg(F.col(c).cast("double")).alias(f"m__{c}") for c in features])
    stack = ", ".join(f"'{c}', `m__{c}`" for c in features)
    long = wide.selectExpr(*keys, "error_kind", "errors", f"stack({len(features)}, {stack}) AS (feature, mean)")
    w = Window.partitionBy(*keys, "error_kind").orderBy(F.col("mean").desc_nulls_last(), F.col("feature"))
    # at most len(features) rows per window partition
    return long.withColumn("rank", F.row_number().over(w))


def business_impact(df: DataFrame, cost_fp: float = S.COST_FALSE_POSITIVE,
                    cost_fn: float = S.COST_FALSE_NEGATIVE, saving_tp: float = S.SAVING_TRUE_POSITIVE,
                    **kw) -> DataFrame:
    """Costs, savings, net benefit and efficiency ratios."""
    c = confusion_counts(df, **kw)
    tp, fp, tn, fn = (F.col(x) for x in ("tp", "fp", "tn", "fn"))
    return c.select(
        *_keys(df), (tp + fp + tn + fn).alias("total_predictions"), (tp + fp).alias("maintenance_predicted"),
        (tp + fn).alias("actual_maintenance_needed"), tp.alias("correctly_predicted_maintenance"),
        fn.alias("missed_maintenance_opportunities"), fp.alias("unnecessary_maintenance_alerts"),
        (fp * F.lit(cost_fp)).alias("false_positive_cost"), (fn * F.lit(cost_fn)).alias("false_negative_cost"),
        (tp * F.lit(saving_tp)).alias("true_positive_savings"),
        (tp * F.lit(saving_tp) - fp * F.lit(cost_fp) - fn * F.lit(cost_fn)).alias("net_benefit"),
        _ratio(tp, tp + fp).alias("maintenance_precision"), _ratio(tp, tp + fn).alias("maintenance_recall"),
        _ratio(tp + tn, tp + tn + fp + fn).alias("alert_accuracy"))


def score_counts(df: DataFrame, label: str = "label", score: str = "score",
                 bin_width: float | None = None) -> DataFrame:
    """Positives / negatives per distinct score (optionally binned down)."""
    s = F.col(score).cast("double")
    if bin_width:
        s = F.floor(s / F.lit(bin_width)) * F.lit(bin_width)
    y = _pos(label)
    return (df.withColumn("_s", s).groupBy(*_keys(df), "_s")
            .agg(F.count_if(y).alias("tp_at"), F.count_if(~y).alias("fp_at"))
            .withColumnRenamed("_s", "threshold"))


def curve_points(df: DataFrame, label: str = "label", score: str = "score",
                 bin_width: float | None = None, max_rows: int | None = None) -> DataFrame:
    """Cumulative TP/FP for every distinct threshold, highest first."""
    counts = score_counts(df, label, score, bin_width)
    keys = _keys(df)
    gkeys = keys or ["_g"]
    if not keys:
        counts = counts.withColumn("_g", F.lit(0))
    seg = segment(counts, gkeys, -F.col("threshold"), **({"max_rows": max_rows} if max_rows else {}))
    run = ordered_scan(seg, order=[F.col("threshold").desc()],
                       sums={"tp": F.col("tp_at"), "fp": F.col("fp_at")})
    totals = counts.groupBy(*gkeys).agg(F.sum("tp_at").alias("pos"), F.sum("fp_at").alias("neg"))
    out = run.join(totals, gkeys).select(*gkeys, "threshold", "tp_at", "fp_at", "tp", "fp", "pos", "neg")
    return out.drop("_g") if not keys else out


def roc_points(df: DataFrame, **kw) -> DataFrame:
    pts = curve_points(df, **kw)
    keys = _keys(df)
    return pts.select(*keys, "threshold", _ratio(F.col("fp"), F.col("neg")).alias("fpr"),
                      _ratio(F.col("tp"), F.col("pos")).alias("tpr"))


def pr_points(df: DataFrame, **kw) -> DataFrame:
    pts = curve_points(df, **kw)
    keys = _keys(df)
    return pts.select(*keys, "threshold", _ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
                      _ratio(F.col("tp"), F.col("pos")).alias("recall"))


def binned_curve(df: DataFrame, bins: int = S.CURVE_BINS, label: str = "label", score: str = "score") -> DataFrame:
    """X1 / X2 with a bounded number of points: cumulative counts at the lower edges of ``bins`` equal bins over [0, 1].

    Exact at those thresholds (score >= edge); scores outside [0, 1] fall into
    the outer bins.  Partial histograms add up, so that a table of any size or
    number of distinct scores shuffles ``bins`` sums for each task and model.
    Returns threshold, tp, fp, fpr, tpr, precision for every edge, also of empty bins.
    """
    keys, y = _keys(df), _pos(label)
    edge = F.greatest(F.lit(0), F.least(F.lit(bins - 1), F.floor(F.col(score).cast("double") * bins))).cast("int")
    # a product with the number of bins may round across an edge; the edge itself decides
    edge = edge + F.when(F.col(score) < edge / F.lit(float(bins)), -1).when((edge < bins - 1) & (F.col(score) >= (edge + 1) / F.lit(float(bins))), 1).otherwise(0)
    hist = (df.filter(y.isNotNull() & F.col(score).isNotNull()).select(*keys, F.greatest(F.lit(0), edge).alias("_bin"), y.alias("_y"))
            .groupBy(*keys, "_bin").agg(F.count_if("_y").alias("tp_at"), F.count_if(~F.col("_y")).alias("fp_at")))
    every = (hist.select(*keys).distinct() if keys else df.sparkSession.range(1).select()).select(*keys, F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("_bin"))
    full = every.join(hist, [*keys, "_bin"], "left").na.fill(0, ["tp_at", "fp_at"])
    w = Window.partitionBy(*keys).orderBy(F.col("_bin").desc())   # ``bins`` rows per model
    all_ = Window.partitionBy(*keys)
    pts = full.select(*keys, (F.col("_bin") / F.lit(float(bins))).alias("threshold"), F.sum("tp_at").over(w).alias("tp"), F.sum("fp_at").over(w).alias("fp"),
                      F.sum("tp_at").over(all_).alias("_pos"), F.sum("fp_at").over(all_).alias("_neg"))
    return pts.select(*keys, "threshold", "tp", "fp", _ratio(F.col("fp"), F.col("_neg")).alias("fpr"), _ratio(F.col("tp"), F.col("_pos")).alias("tpr"),
                      _ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"))


def auc_ap(df: DataFrame, **kw) -> DataFrame:
    """ROC AUC (trapezoids, exact integer numerator) and average precision (step sum)."""
    pts = curve_points(df, **kw)
    keys = _keys(df)
    tp, fp, tp_at, fp_at = F.col("tp"), F.col("fp"), F.col("tp_at"), F.col("fp_at")
    agg = pts.groupBy(*keys).agg(
        F.sum(fp_at * (2 * tp - tp_at)).alias("_num"), F.first("pos").alias("pos"),
        F.first("neg").alias("neg"),
        F.sum(F.when(tp + fp > 0, tp_at.cast("double") * tp / (tp + fp)).otherwise(0.0)).alias("_ap"))
    return agg.select(*keys, _ratio(F.col("_num"), 2 * F.col("pos") * F.col("neg")).alias("roc_auc"),
                      _ratio(F.col("_ap"), F.col("pos")).alias("avg_precision"))


def probability_histogram(df: DataFrame, bins: int = S.HISTOGRAM_BINS, label: str = "label",
                          score: str = "score") -> DataFrame:
    """Counts of scores per class in ``bins`` equal bins over [0, 1]."""
    b = F.least(F.lit(bins - 1), F.greatest(F.lit(0), F.floor(F.col(score) * bins).cast("int")))
    return (df.groupBy(*_keys(df), F.col(label).cast("int").alias("class"), b.alias("bin"))
            .agg(F.count(F.lit(1)).alias("count"))
            .withColumn("bin_start", F.col("bin") / F.lit(float(bins))))


def confusion_cells(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row per (actual, predicted) cell."""
    return (df.groupBy(*_keys(df), F.col(label).cast("int").alias("actual"),
                       F.col(prediction).cast("int").alias("predicted"))
            .agg(F.count(F.lit(1)).alias("count")))


def model_comparison(df: DataFrame, **kw) -> DataFrame:
    """Accuracy / precision / recall / F1 / AUC per model as long rows."""
    keys = _keys(df)
    if keys:
        m = classification_metrics(df).join(auc_ap(df), keys)
    else:   # one row each
        m = classification_metrics(df).withColumn("_k", F.lit(1)).join(auc_ap(df).withColumn("_k", F.lit(1)), "_k")
    names = ["accuracy", "precision", "recall", "f1_score", "roc_auc"]
    stack = ", ".join(f"'{n}', {n}" for n in names)
    return m.selectExpr(*keys, f"stack({len(names)}, {stack}) AS (metric, value)")


# --------------------------------------------------------------- resampling
def uniform_hash(*cols: Column) -> Column:
    """Deterministic U[0,1) from the md5 of the given values (52 bits)."""
    h = F.md5(F.concat_ws("|", *[c.cast("string") for c in cols]))
    return F.conv(F.substring(h, 1, 13), 16, 10).cast("double") / F.lit(float(2 ** 52))


def poisson_cuts(kmax: int = 12) -> list:
    """Upper bounds of the Poisson(1) classes 0, 1, ... as 13 hex digits of a 52-bit uniform.

    A uniform is below a bound as a number exactly if its digits are below
    the bound's as text.  Draws above ``kmax`` (probability 1e-10) count as ``kmax``.
    """
    cdf, term, cuts = 0.0, math.exp(-1.0), []
    for k in range(kmax):
        cdf += term
        term /= (k + 1)
        cuts.append(format(math.ceil(cdf * 2 ** 52), "013x"))
    return cuts


def poisson1(digits: Column) -> Column:
    """Poisson(1) draw by inverse CDF of a uniform, given as 13 lower-case hex digits."""
    cuts, expr = poisson_cuts(), None
    for k, cut in enumerate(cuts):
        expr = F.when(digits < cut, F.lit(k)) if expr is None else expr.when(digits < cut, F.lit(k))
    return expr.otherwise(F.lit(len(cuts)))


def _drawn(df: DataFrame, row_id: Column, replicates: int, seed: int, *columns: Column) -> DataFrame:
    """``columns`` of each row once for each block ``_k`` of four replicates, with its weights ``_w0`` to ``_w3`` in them.

    Each row gets one Poisson(1) weight per replicate from a hash of (row,
    seed, k): 64 hex digits, of which 1-13, 14-26, 27-39 and 40-52 are the
    uniforms of replicates 4k to 4k+3.  The partial aggregate that follows takes
    the rows up at once.
    """
    blocks = (replicates + 3) // 4
    rows = df.select(*_keys(df), *columns, row_id.cast("string").alias("_rid"))
    rows = rows.withColumn("_k", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    rows = rows.withColumn("_h", F.sha2(F.concat_ws("|", "_rid", F.lit(str(seed)), F.col("_k").cast("string")), 256))
    return rows.withColumns({f"_w{j}": poisson1(F.substring("_h", 1 + 13 * j, 13)) for j in range(4)}).drop("_rid", "_h")


def _by_replicate(wide: DataFrame, keys: list, names: list, replicates: int) -> DataFrame:
    """One row per replicate of the sums ``name0`` to ``name3`` of each block."""
    stack = ", ".join(", ".join([str(j), *(f"{n}{j}" for n in names)]) for j in range(4))
    return (wide.selectExpr(*keys, "_k", f"stack(4, {stack}) AS (_j, {', '.join(names)})")
            .withColumn("replicate", F.col("_k") * 4 + F.col("_j")).filter(F.col("replicate") < replicates)
            .select(*keys, "replicate", *names))


def bootstrap_f1(df: DataFrame, row_id: Column, replicates: int = S.BOOTSTRAP_REPLICATES,
                 seed: int = S.SPLIT_SEED, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Poisson bootstrap of F1; per-replicate weighted confusion in one pass (weights: see ``_drawn``).

    What is shuffled is a few sums for each block of replicates.
    Returns one row per replicate: (replicate, tp, fp, fn, f1_score).
    """
    y, p = _pos(label), F.col(prediction).cast("int") == 1
    cell = (F.when(y & p, F.lit(1)).when(~y & p, F.lit(2)).when(y & ~p, F.lit(3))).alias("_cell")
    keys = _keys(df)
    rows = _drawn(df.filter(cell.isNotNull()), row_id, replicates, seed, cell)
    aggs = [F.sum(F.when(F.col("_cell") == code, F.col(f"_w{j}")).otherwise(0)).alias(f"{n}{j}")
            for j in range(4) for code, n in ((1, "tp"), (2, "fp"), (3, "fn"))]
    long = _by_replicate(rows.groupBy(*keys, "_k").agg(*aggs), keys, ["tp", "fp", "fn"], replicates)
    return long.withColumn("f1_score", _ratio(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")))


def bootstrap_auc(df: DataFrame, row_id: Column, replicates: int = S.BOOTSTRAP_REPLICATES,
                  seed: int = S.SPLIT_SEED, label: str = "label", score: str = "score",
                  max_rows: int | None = None) -> DataFrame:
    """Poisson bootstrap of the ROC AUC, with the same weights as ``bootstrap_f1``.

    A replicate's AUC is the weighted share of (positive, negative) pairs that
    the score puts in order, ties counting half.  All replicates are summed at
    once: rows become weighted positives and negatives of each (block, distinct
    score), and the segmented scan adds up the negatives below each score, so
    neither a block nor a score puts all rows into one task.  Rows
    without a label or score are left out.  Returns (replicate, pos, neg,
    roc_auc); without positives or negatives the AUC is 0.
    """
    y, keys = _pos(label), _keys(df)
    value = F.col(score).cast("double")
    rows = _drawn(df.filter(y.isNotNull() & value.isNotNull()), row_id, replicates, seed, y.alias("_y"), value.alias("_s"))
    sums = [F.sum(F.when(F.col("_y") == side, F.col(f"_w{j}")).otherwise(0)).alias(f"{n}{j}") for j in range(4) for side, n in ((True, "pos"), (False, "neg"))]
    counts = materialize(rows.groupBy(*keys, "_k", "_s").agg(*sums))
    seg = segment(counts, [*keys, "_k"], "_s", **({"max_rows": max_rows} if max_rows else {}))
    run = ordered_scan(seg, order=[F.col("_s")], sums={f"up{j}": F.col(f"neg{j}") for j in range(4)})
    exact = "decimal(38,0)"
    ranks = [F.sum((F.col(f"pos{j}").cast("decimal(18,0)") * (2 * F.col(f"up{j}") - F.col(f"neg{j}")).cast("decimal(19,0)")).cast(exact)).alias(f"num{j}") for j in range(4)]
    both = [F.sum(f"{n}{j}").alias(f"{n}{j}") for j in range(4) for n in ("pos", "neg")]
    long = _by_replicate(run.groupBy(*keys, "_k").agg(*ranks, *both), keys, ["num", "pos", "neg"], replicates)
    auc = _ratio(F.col("num").cast("double"), 2.0 * F.col("pos").cast("double") * F.col("neg").cast("double"))
    return long.select(*keys, "replicate", "pos", "neg", auc.alias("roc_auc"))


def stability_summary(boot: DataFrame, metric: str = "f1_score") -> DataFrame:
    """mean / population std / min / max / 2.5 and 97.5 percentiles over replicates, and the metric's name."""
    keys = [MODEL] if MODEL in boot.columns else []
    m = F.col(metric)
    return boot.groupBy(*keys).agg(
        F.avg(m).alias("mean"), F.stddev_pop(m).alias("std"), F.min(m).alias("min"), F.max(m).alias("max"),
        F.percentile(m, 0.025).alias("ci_low"), F.percentile(m, 0.975).alias("ci_high")).withColumn("metric", F.lit(metric))


def sample_rows(df: DataFrame, n: int, order: list, seed: int | None = None) -> DataFrame:
    """T5: the first ``n`` rows by ``order``, or with ``seed`` by a hash of seed and these columns (then by them).

    A top-k: every task keeps ``n`` rows, nothing is sorted whole, and reruns agree.
    """
    cols = [F.col(c) for c in order]
    first = [] if seed is None else [F.md5(F.concat_ws("|", F.lit(str(seed)), *[c.cast("string") for c in cols]))]
    return df.orderBy(*first, *cols).limit(n)


def hash_fold(row_id: Column, folds: int, seed: int = S.SPLIT_SEED) -> Column:
    """Fold 0 to ``folds`` - 1 of a row by its identity: the same in every run, on every partitioning."""
    return F.least(F.lit(folds - 1), F.floor(uniform_hash(row_id, F.lit(f"fold{seed}")) * folds)).cast("int")


SPLIT_BINS = 2 ** 12   # of the uniform hash, in the search for the last test row of a class


def _split_cuts(ids: DataFrame, test_fraction: float, max_rows: int | None) -> DataFrame:
    """The last test row of each class in the order of ``_u`` and ``_rid``: (_cls, _cut_u, _cut_rid, _take, _same).

    Counts of equal bins of the hash tell the bin that holds it, and a
    segmented scan ranks the rows of that bin alone.  ``_same`` rows are equal to it, of which the first ``_take`` count.
    """
    bin_ = F.floor(F.col("_u") * SPLIT_BINS)
    counts = materialize(ids.groupBy("_cls", bin_.alias("_bin")).agg(F.count(F.lit(1)).alias("_c")))
    by_bin = Window.partitionBy("_cls").orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)   # SPLIT_BINS rows a class
    need = F.round(F.sum("_c").over(Window.partitionBy("_cls")) * F.lit(test_fraction)) - F.coalesce(F.sum("_c").over(by_bin), F.lit(0))
    held = counts.select("_cls", "_bin", "_c", need.alias("_need")).filter((F.col("_need") > 0) & (F.col("_need") <= F.col("_c")))
    near = ids.withColumn("_bin", bin_).join(F.broadcast(materialize(held.drop("_c"))), ["_cls", "_bin"])
    near = materialize(near.select("_cls", "_u", "_rid", "_need"))
    ranked = ordered_scan(segment(near, ["_cls"], F.col("_u"), **({"max_rows": max_rows} if max_rows else {})),
                          order=[F.col("_u"), F.col("_rid")], position="_rank")
    cut = ranked.filter(F.col("_rank") == F.col("_need")).select("_cls", F.col("_u").alias("_cut_u"), F.col("_rid").alias("_cut_rid"))
    cut = materialize(cut)
    equal = ranked.join(F.broadcast(cut), "_cls").filter((F.col("_u") == F.col("_cut_u")) & F.col("_rid").eqNullSafe(F.col("_cut_rid")))
    return materialize(equal.groupBy("_cls", "_cut_u", "_cut_rid").agg(F.count_if(F.col("_rank") <= F.col("_need")).alias("_take"),
                                                                       F.count(F.lit(1)).alias("_same")))


def stratified_split(df: DataFrame, row_id: Column, label: str = "label",
                     test_fraction: float = S.TEST_FRACTION, seed: int = S.SPLIT_SEED,
                     max_rows: int | None = None) -> DataFrame:
    """Exact stratified split; adds boolean ``is_test``.

    Within each class rows are ordered by a seeded hash; the first
    round(test_fraction * n_class) rows are the test set.  Only the last of
    them is searched for (``_split_cuts``); rows are compared with it where they are, none is
    shuffled.  Rows that share the identity of the last one and are too many are numbered; rows without a class are left out.
    """
    ids = df.select(F.col(label).alias("_cls"), uniform_hash(row_id, F.lit(seed)).alias("_u"), row_id.cast("string").alias("_rid"))
    cuts = _split_cuts(ids.filter(F.col("_cls").isNotNull()), test_fraction, max_rows)
    out = (df.filter(F.col(label).isNotNull())
           .withColumns({"_u": uniform_hash(row_id, F.lit(seed)), "_rid": row_id.cast("string"), "_cls": F.col(label)})
           .join(F.broadcast(cuts), "_cls", "left"))
    at = (F.col("_u") == F.col("_cut_u")) & F.col("_rid").eqNullSafe(F.col("_cut_rid"))
    # a null identity comes first among rows of one hash, as in the order of the ranks
    below = (F.col("_u") < F.col("_cut_u")) | ((F.col("_u") == F.col("_cut_u")) & (F.col("_rid").isNull() | (F.col("_rid") <= F.col("_cut_rid"))))
    out = out.withColumn("is_test", F.coalesce(at | below, F.lit(False)))
    over = cuts.filter(F.col("_take") < F.col("_same"))
    if not over.isEmpty():
        tied = F.coalesce(at & (F.col("_take") < F.col("_same")), F.lit(False))
        number = F.row_number().over(Window.partitionBy("_cls").orderBy("_u"))   # rows of one identity
        out = out.filter(~tied).unionByName(out.filter(tied).withColumn("is_test", number <= F.col("_take")))
    return out.select(*df.columns, "is_test")
