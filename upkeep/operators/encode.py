"""Categorical encoding, scaling and the final feature matrix.

Fitted state is kept as small DataFrames (vocabulary and scaler tables) and
can be saved as Parquet and reloaded.  Applying a label vocabulary is an
equi-join: a broadcast hash join when the vocabulary's counted size is at
most ``INLINE_VOCAB_MAX`` rows, a shuffle join beyond that.  Vocabularies of a
few dozen values are literal maps, as a chain of joins makes the generated
code of a wide row too long to be compiled.  One-hot
columns (at most 10 categories by rule) are plain comparisons.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from upkeep import schema as S
from upkeep.session import materialize

INLINE_VOCAB_MAX = 1_000_000   # vocabularies up to this size are broadcast (hash lookup)
SHORT_VOCAB_MAX = 64           # and up to this one they are a literal map of the plan, which needs no join


@dataclass
class FittedEncoding:
    onehot: dict                      # column -> sorted categories (<= 10 by rule)
    label_columns: list               # columns label-encoded with the vocabulary table
    vocab: DataFrame                  # (feature, value, code) codes 0.. in sorted order
    scaler: DataFrame                 # (feature, mean, scale)
    scaled_columns: list
    vocab_sizes: dict = field(default_factory=dict)    # column -> distinct values (counted)


def _string(c: str) -> Column:
    return F.col(c).cast("string")


def value_counts(df: DataFrame, columns: list) -> DataFrame:
    """Rows per (feature, value) of all ``columns`` in one scan; nulls are left out.

    Each row is turned into one (feature, value) row a column, and combined
    before the shuffle, which so carries each distinct value once a task.
    """
    if not columns:
        return df.sparkSession.createDataFrame([], "feature string, value string, rows long")
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), _string(c).alias("value")) for c in columns])
    return (df.select(F.inline(pairs)).filter(F.col("value").isNotNull())
            .groupBy("feature", "value").agg(F.count(F.lit(1)).alias("rows")))


def number_values(values: DataFrame, partitions: int | None = None) -> DataFrame:
    """Codes 0.. of distinct (feature, value) rows: positions in string order within the feature.

    The values are range-partitioned by their whole length, so values that share a long
    prefix still spread; each partition numbers its own, and the counts
    of the partitions before it move the numbers up.
    """
    n = partitions or int(values.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # stored, so that both passes below see the same partitions
    part = materialize(values.select("feature", "value").repartitionByRange(n, "feature", "value")
                       .withColumn("_part", F.spark_partition_id()))
    counts = part.groupBy("feature", "_part").agg(F.count(F.lit(1)).alias("_n"))   # features x partitions rows
    before = F.coalesce(F.sum("_n").over(Window.partitionBy("feature").orderBy("_part")
                                         .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    base = counts.select("feature", "_part", before.alias("_base"))
    own = F.row_number().over(Window.partitionBy("feature", "_part").orderBy("value"))
    return (part.withColumn("_own", own).join(base, ["feature", "_part"])
            .select("feature", "value", (F.col("_base") + F.col("_own") - 1).cast("long").alias("code")))


def fit_label_vocab(df: DataFrame, columns: list, partitions: int | None = None) -> DataFrame:
    """Sorted-class codes per column as a long table (feature, value, code)."""
    return number_values(value_counts(df, columns), partitions)


def by_feature(df: DataFrame, columns: list, *aggs: Column) -> DataFrame:
    """``aggs`` over the column ``value`` of the numbers of each of ``columns``, one row per feature, also of an empty table.

    Each row is turned into one (position, value) row a column.  Several aggregates of
    each of dozens of columns side by side are too many fields for generated code, a few over one value column are not.
    """
    names = F.array(*[F.lit(c) for c in columns])
    rows = df.select(F.posexplode(F.array(*[F.col(c).cast("double") for c in columns])).alias("_i", "value"))
    stats = rows.groupBy("_i").agg(*aggs)
    every = df.sparkSession.range(1).select(F.posexplode(names).alias("_i", "feature"))   # one row per column
    return every.join(F.broadcast(stats), "_i", "left").drop("_i")


def fit_scaler(df: DataFrame, columns: list) -> DataFrame:
    """Mean and population std per column (nulls ignored); zero std -> 1."""
    long = by_feature(df, columns, F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"))
    return long.select("feature", "mean",
                       F.when((F.col("std") == 0) | F.col("std").isNull(), F.lit(1.0))
                       .otherwise(F.col("std")).alias("scale"))


def scaled_columns(df: DataFrame) -> list:
    cols = []
    for c in S.NUMERIC_FEATURES + S.ENGINEERED_NUMERIC:
        if c in df.columns and c not in cols:
            cols.append(c)
    return cols


def fit(df: DataFrame, categorical=S.CATEGORICAL_FEATURES,
        engineered=S.ENGINEERED_CATEGORICALS, max_onehot: int = S.ONE_HOT_MAX_CATEGORIES,
        vocab_partitions: int | None = None) -> FittedEncoding:
    cats = [c for c in categorical if c in df.columns]
    derived = [c for c in engineered if c in df.columns and c not in cats]
    # one scan: the distinct values of every column, from which come the E1/E2 choice, the one-hot values and the codes
    values = materialize(value_counts(df, cats + derived))
    sizes = {r["feature"]: r["n"] for r in values.groupBy("feature").agg(F.count(F.lit(1)).alias("n")).collect()}
    label_cols = [c for c in cats if c in S.ALWAYS_LABEL_ENCODED or sizes.get(c, 0) > max_onehot]
    onehot = {c: [] for c in cats if c not in label_cols}
    label_cols += derived
    # <= max_onehot values per column by the rule above: bounded collect
    for r in values.filter(F.col("feature").isin(list(onehot))).orderBy("value").collect() if onehot else []:
        onehot[r["feature"]].append(r["value"])
    vocab = materialize(number_values(values.filter(F.col("feature").isin(label_cols)), vocab_partitions))
    sizes = {c: sizes[c] for c in label_cols if c in sizes}
    cols = scaled_columns(df)
    # stored, so that applying it does not read the history again
    return FittedEncoding(onehot, label_cols, vocab, materialize(fit_scaler(df, cols)), cols, sizes)


def apply_encoding(df: DataFrame, enc: FittedEncoding) -> DataFrame:
    """Encoded columns: <col>_<value> one-hot doubles, <col>_encoded codes (-1 unseen)."""
    out = df
    onehot_cols = {}
    for c, cats in enc.onehot.items():
        if c not in out.columns:
            continue
        for v in cats:
            onehot_cols[f"{c}_{v}"] = F.coalesce((_string(c) == F.lit(v)).cast("double"), F.lit(0.0))
    if onehot_cols:
        out = out.withColumns(onehot_cols)
    short = [c for c in enc.label_columns if c in out.columns and 0 < enc.vocab_sizes.get(c, 0) <= SHORT_VOCAB_MAX]
    codes = {c: [] for c in short}
    # at most SHORT_VOCAB_MAX rows per column: bounded collect
    for r in enc.vocab.filter(F.col("feature").isin(short)).collect() if short else []:
        codes[r["feature"]] += [F.lit(r["value"]), F.lit(r["code"]).cast("long")]
    for c in enc.label_columns:
        if c not in out.columns:
            continue
        if c in codes:
            out = out.withColumn(f"{c}_encoded", F.coalesce(F.create_map(*codes[c])[_string(c)], F.lit(-1).cast("long")))
            continue
        v = enc.vocab.filter(F.col("feature") == c).select(
            F.col("value").alias(f"__v_{c}"), F.col("code").alias(f"{c}_encoded"))
        if enc.vocab_sizes.get(c, INLINE_VOCAB_MAX + 1) <= INLINE_VOCAB_MAX:
            v = F.broadcast(v)     # size counted at fit time
        out = (out.join(v, _string(c) == F.col(f"__v_{c}"), "left").drop(f"__v_{c}")
               .withColumn(f"{c}_encoded", F.coalesce(f"{c}_encoded", F.lit(-1).cast("long"))))
    return out


def apply_scaler(df: DataFrame, enc: FittedEncoding, scaler_row=None) -> DataFrame:
    """(x - mean) / scale for the fitted numeric columns; nulls stay null."""
    stats = scaler_row or {r["feature"]: (r["mean"], r["scale"]) for r in enc.scaler.collect()}
    exprs = {}
    for c in enc.scaled_columns:
        if c in df.columns and c in stats:
            mean, scale = stats[c]
            mean = 0.0 if mean is None else mean
            exprs[c] = (F.col(c).cast("double") - F.lit(mean)) / F.lit(scale)
    return df.withColumns(exprs)


def final_feature_columns(df: DataFrame, label: str = "maintenance_needed",
                          extra_exclude=()) -> list:
    """Numeric columns minus identifiers, raw categoricals and the target."""
    numeric = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
               T.DecimalType, T.BooleanType)
    exclude = set(S.FINAL_EXCLUDE) | {label, "technician_id", "record_id", "days_to_next_maintenance"}
    exclude |= set(extra_exclude)
    cols = []
    for f in df.schema.fields:
        if f.name in exclude or f.name.startswith("_"):
            continue
        if isinstance(f.dataType, numeric) and not isinstance(f.dataType, T.BooleanType):
            cols.append(f.name)
    return cols


def final_features(df: DataFrame, feature_cols: list, keep=()) -> DataFrame:
    """Select the feature matrix; remaining nulls become 0."""
    return df.select(*keep, *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c)
                              for c in feature_cols])


def feature_statistics(df: DataFrame, feature_cols: list) -> DataFrame:
    """mean / sample std / min / max per feature as a long table."""
    return by_feature(df, feature_cols, F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
                      F.min("value").alias("min"), F.max("value").alias("max"))


def save(enc: FittedEncoding, path: str) -> None:
    """Persist fitted state as Parquet tables (K2)."""
    spark = enc.vocab.sparkSession
    enc.vocab.write.mode("overwrite").parquet(f"{path}/vocab")
    enc.scaler.write.mode("overwrite").parquet(f"{path}/scaler")
    meta = [(c, v, i) for c, vals in enc.onehot.items() for i, v in enumerate(vals)]
    spark.createDataFrame(meta, "feature string, value string, pos int").write.mode("overwrite").parquet(f"{path}/onehot")
    spark.createDataFrame(list(enumerate(enc.label_columns)), "pos int, feature string").write.mode("overwrite").parquet(f"{path}/label_columns")
    spark.createDataFrame(list(enumerate(enc.scaled_columns)), "pos int, feature string").write.mode("overwrite").parquet(f"{path}/scaled_columns")


def load(spark: SparkSession, path: str) -> FittedEncoding:
    vocab = spark.read.parquet(f"{path}/vocab")
    scaler = spark.read.parquet(f"{path}/scaler")
    onehot = {}
    for r in spark.read.parquet(f"{path}/onehot").orderBy("feature", "pos").collect():
        onehot.setdefault(r["feature"], []).append(r["value"])
    label_cols = [r["feature"] for r in spark.read.parquet(f"{path}/label_columns").orderBy("pos").collect()]
    scaled = [r["feature"] for r in spark.read.parquet(f"{path}/scaled_columns").orderBy("pos").collect()]
    sizes = {r["feature"]: r["n"] for r in vocab.groupBy("feature").agg(F.count(F.lit(1)).alias("n")).collect()}
    return FittedEncoding(onehot, label_cols, vocab, scaler, scaled, sizes)
