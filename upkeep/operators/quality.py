"""Validation and cleaning of maintenance records.

The seven cleaning stages run in a fixed order because later stages depend
on earlier ones (fills are computed over rows that the business rules later
remove; duplicates are found among rows that passed the rules; building
counts are taken after the date filter):

  1 required columns / essentials   (P2, P3, P4)
  2 type coercion                   (S6, P5)
  3 missing values                  (P6, F17, A1, A2, A3)
  4 business rules                  (P7)
  5 duplicates, keep first          (W9)
  6 date range                      (P8)
  7 minimum records per building    (A4 / J13)
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from upkeep import schema as S
from upkeep.functions.expressions import parse_bool
from upkeep.operators.stats import broadcast_if_small, exact_median, lowest_mode
from upkeep.session import materialize

STAGES = ["missing_columns", "invalid_types", "excessive_missing", "business_logic",
          "duplicates", "invalid_dates", "insufficient_building_data"]


# ---------------------------------------------------------------- stage 1
def ensure_required_columns(df: DataFrame, required=S.REQUIRED_COLUMNS) -> DataFrame:
    """Add defaults for absent optional measures; fail on absent required columns."""
    defaults = {"downtime_days": F.lit(0).cast("long"), "maintenance_cost": F.lit(0.0),
                "technician_id": F.lit(None).cast("long"), "period_days": F.lit(None).cast("long")}
    missing_required = [c for c in required if c not in df.columns and c not in defaults]
    if missing_required:
        raise ValueError(f"Required column missing: {', '.join(missing_required)}")
    add = {c: e for c, e in defaults.items() if c not in df.columns}
    return df.withColumns(add) if add else df


def drop_missing_essentials(df: DataFrame, essentials=S.ESSENTIAL_COLUMNS) -> DataFrame:
    return df.dropna(subset=list(essentials))


# ---------------------------------------------------------------- stage 2
def coerce_types(df: DataFrame, schema: T.StructType = S.RECORD_SCHEMA) -> DataFrame:
    """Cast every record column to its canonical type; bad values become null."""
    exprs = {}
    current = {f.name: f.dataType for f in df.schema.fields}
    for field in schema.fields:
        name, target = field.name, field.dataType
        if name not in current or current[name] == target:
            continue
        col = F.col(name)
        if isinstance(target, T.BooleanType):
            exprs[name] = parse_bool(col)
        elif isinstance(target, T.TimestampType):
            exprs[name] = (F.try_to_timestamp(col.cast("string"))
                           if isinstance(current[name], T.StringType) else col.try_cast(target))
        elif isinstance(target, T.LongType) and isinstance(current[name], (T.DoubleType, T.FloatType)):
            # fractional values are not integers: null instead of truncation
            exprs[name] = F.when(col == F.floor(col), col.try_cast(target))
        elif isinstance(target, T.LongType) and isinstance(current[name], T.StringType):
            d = col.try_cast("double")
            exprs[name] = F.when(d == F.floor(d), d.try_cast(target))
        else:
            exprs[name] = col.try_cast(target)
    return df.withColumns(exprs) if exprs else df


def drop_invalid_types(df: DataFrame, essentials=S.TYPED_ESSENTIALS) -> DataFrame:
    return df.dropna(subset=list(essentials))


# ---------------------------------------------------------------- stage 3
def null_count(columns) -> Column:
    return reduce(lambda a, b: a + b, [F.col(c).isNull().cast("int") for c in columns])


def missing_share_ok(df: DataFrame, columns=S.RECORD_COLUMNS,
                     max_fraction: float = S.MAX_MISSING_FRACTION) -> Column:
    cols = [c for c in columns if c in df.columns]
    return null_count(cols) / F.lit(len(cols)) <= F.lit(max_fraction)


def drop_excessive_missing(df: DataFrame, columns=S.RECORD_COLUMNS,
                           max_fraction: float = S.MAX_MISSING_FRACTION) -> DataFrame:
    return df.filter(missing_share_ok(df, columns, max_fraction))


def fill_downtime(df: DataFrame) -> DataFrame:
    """No failure reported -> missing downtime is 0."""
    return df.withColumn("downtime_days", F.when(F.col("failure_reported") == F.lit(False),
                                                 F.coalesce(F.col("downtime_days"), F.lit(0).cast("long")))
                         .otherwise(F.col("downtime_days")))


def cost_counts(df: DataFrame) -> DataFrame:
    """Rows per (asset_type, maintenance_cost), nulls included: all that the two medians of A1 need."""
    return df.groupBy("asset_type", "maintenance_cost").agg(F.count(F.lit(1)).alias("rows"))


def cost_medians(df: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    counts = cost_counts(df) if counts is None else counts
    return exact_median(counts.filter(F.col("asset_type").isNotNull()), ["asset_type"], "maintenance_cost",
                        out="cost_median", weight="rows")


def fill_cost(df: DataFrame) -> DataFrame:
    """Median cost of the asset type, then the median of the filled column (A1).

    The records are read once, for the count table; both medians come from it.
    """
    counts = materialize(cost_counts(df))
    med = broadcast_if_small(cost_medians(df, counts))
    cost = F.coalesce("maintenance_cost", "cost_median")
    filled = counts.join(med, on="asset_type", how="left").select(cost.alias("maintenance_cost"), "rows")
    # a single value: fetched once, so later stages do not recompute it
    overall = exact_median(filled, [], "maintenance_cost", out="_overall", weight="rows").first()
    fallback = F.lit(overall["_overall"] if overall else None).cast("double")
    return (df.join(med, on="asset_type", how="left")
            .withColumn("maintenance_cost", F.coalesce(cost, fallback))
            .drop("cost_median"))


def period_modes(df: DataFrame) -> DataFrame:
    prev = df.filter(F.col("maintenance_type") == "preventive")
    return lowest_mode(prev, ["asset_type"], "period_days", out="period_mode")


def fill_period(df: DataFrame, default: int = S.DEFAULT_PERIOD_DAYS, modes: DataFrame | None = None) -> DataFrame:
    """Preventive rows: missing period -> the type's most common period, else 90 (A2)."""
    modes = broadcast_if_small(period_modes(df) if modes is None else modes)
    is_prev = F.col("maintenance_type") == "preventive"
    return (df.join(modes, on="asset_type", how="left")
            .withColumn("period_days",
                        F.when(is_prev & F.col("period_days").isNull(),
                               F.coalesce(F.col("period_mode"), F.lit(default).cast("long")))
                        .otherwise(F.col("period_days")))
            .drop("period_mode"))


def technician_modes(df: DataFrame) -> DataFrame:
    return lowest_mode(df, ["building_id"], "technician_id", out="technician_mode")


def fill_technician(df: DataFrame, default: int = S.DEFAULT_TECHNICIAN_ID, modes: DataFrame | None = None) -> DataFrame:
    """Missing technician -> the building's most frequent technician, else 1 (A3).

    One row per building: a shuffle join (AQE broadcasts it at run time when
    small and splits skewed buildings otherwise) of the rows without a technician; the others stay where they are.
    """
    modes = technician_modes(df) if modes is None else modes
    missing = F.col("technician_id").isNull()
    filled = (df.filter(missing).join(modes, on="building_id", how="left")
              .withColumn("technician_id", F.coalesce(F.col("technician_mode"), F.lit(default).cast("long"))))
    return df.filter(~missing).unionByName(filled.select(*df.columns))


def fill_missing(df: DataFrame) -> DataFrame:
    """Cost, period and technician.

    No fill changes what another one counts, so the modes are taken from the
    rows as given and not from a plan that holds the fills before.
    """
    out = fill_cost(df)
    out = fill_period(out, modes=period_modes(df))
    return fill_technician(out, modes=technician_modes(df))


def handle_missing(df: DataFrame, columns=S.RECORD_COLUMNS, checkpoint: bool = False) -> DataFrame:
    df = fill_downtime(drop_excessive_missing(df, columns))
    if checkpoint:
        # the fills read these rows four times (cost counts, two modes, the fill)
        df = materialize(df)
    return fill_missing(df)


# ---------------------------------------------------------------- stage 4
def rule_predicates() -> dict:
    """Named business-rule violations (each may be null on null input)."""
    c = F.col
    return {
        "non_positive_area": c("building_area") <= 0,
        "non_positive_floors": c("building_floors") <= 0,
        "negative_cost": c("maintenance_cost") < 0,
        "negative_downtime": c("downtime_days") < 0,
        "downtime_without_failure": (c("failure_reported") == F.lit(False)) & (c("downtime_days") > 1),
        "period_out_of_range": (c("period_days") < S.PERIOD_MIN_DAYS) | (c("period_days") > S.PERIOD_MAX_DAYS),
    }


def violation_flag(strict_nulls: bool = False) -> Column:
    preds = rule_predicates()
    if strict_nulls:
        # Nullable-integer semantics: an unknown integer comparison removes the
        # row; float comparisons with a missing value are plain false.
        preds = {k: (F.coalesce(v, F.lit(False)) if k in ("non_positive_area", "negative_cost") else v)
                 for k, v in preds.items()}
        return F.coalesce(reduce(lambda a, b: a | b, preds.values()), F.lit(True))
    return reduce(lambda a, b: a | b, [F.coalesce(v, F.lit(False)) for v in preds.values()])


def drop_rule_violations(df: DataFrame, strict_nulls: bool = False) -> DataFrame:
    return df.filter(~violation_flag(strict_nulls))


def rule_violation_counts(df: DataFrame) -> DataFrame:
    """One row per rule: how many records break it (rows may break several)."""
    preds = rule_predicates()
    wide = df.agg(*[F.count_if(F.coalesce(p, F.lit(False))).alias(k) for k, p in preds.items()],
                  F.count_if(violation_flag()).alias("any_rule"))
    names = list(preds) + ["any_rule"]
    stack = ", ".join(f"'{n}', {n}" for n in names)
    return wide.selectExpr(f"stack({len(names)}, {stack}) AS (rule, violations)")


# ---------------------------------------------------------------- stage 5
def drop_duplicates_first(df: DataFrame, key=S.DUPLICATE_KEY, tie=None, copies: str | None = None) -> DataFrame:
    """Keep the first record of each duplicate key in ``tie`` order.

    ``copies`` names a column for the number of records that the kept one stands for.

    ``min_by`` is a partial aggregate: a key with millions of copies is
    combined map-side instead of landing in one task.
    """
    key = [k for k in key if k in df.columns]
    tie = list(tie) if tie else [c for c in df.columns if c not in key]
    rest = [c for c in df.columns if c not in key]
    number = [F.count(F.lit(1)).alias(copies)] if copies else []
    kept = df.groupBy(*key).agg(
        F.min_by(F.struct(*[F.col(c) for c in rest]), F.struct(*[F.col(c) for c in tie])).alias("_r"), *number)
    return kept.select(*key, "_r.*", *([copies] if copies else [])).select(*df.columns, *([copies] if copies else []))


def drop_stored_duplicates(df: DataFrame, key=S.DUPLICATE_KEY, tie=None, copies: str | None = None) -> DataFrame:
    """As ``drop_duplicates_first``, for rows that are cheap to read more than once.

    Counts of a 64-bit hash of the key find the keys that may repeat; only
    their rows are shuffled whole and compared by the key itself. All others are kept where they are.
    """
    key = [k for k in key if k in df.columns]
    mark = F.xxhash64(*key)
    several = broadcast_if_small(df.groupBy(mark.alias("_h")).agg(F.count(F.lit(1)).alias("_c")).filter(F.col("_c") > 1).select("_h"))
    marked = df.withColumn("_h", mark)
    alone = marked.join(several, "_h", "left_anti").drop("_h")
    first = drop_duplicates_first(marked.join(several, "_h", "left_semi").drop("_h"), key=key, tie=tie, copies=copies)
    return (alone.withColumn(copies, F.lit(1).cast("long")) if copies else alone).unionByName(first)


# ---------------------------------------------------------------- stage 6
def date_out_of_range(as_of: str, max_age_days: int = S.MAX_AGE_DAYS, future_days: int = S.FUTURE_SLACK_DAYS) -> Column:
    t = F.to_timestamp(F.lit(as_of))
    newest = t + F.make_interval(days=F.lit(future_days))
    oldest = t - F.make_interval(days=F.lit(max_age_days))
    d = F.col("maintenance_date")
    return (d > newest) | (d < oldest)


def filter_date_range(df: DataFrame, as_of: str, max_age_days: int = S.MAX_AGE_DAYS,
                      future_days: int = S.FUTURE_SLACK_DAYS) -> DataFrame:
    return df.filter(~date_out_of_range(as_of, max_age_days, future_days))


# ---------------------------------------------------------------- stage 7
def dense_buildings(df: DataFrame, min_records: int = S.MIN_RECORDS_PER_BUILDING) -> DataFrame:
    return (df.groupBy("building_id").agg(F.count(F.lit(1)).alias("_n"))
            .filter(F.col("_n") >= min_records).select("building_id"))


def sparse_buildings(df: DataFrame, min_records: int = S.MIN_RECORDS_PER_BUILDING) -> DataFrame:
    """Buildings of ``df`` that ``dense_buildings`` leaves out."""
    return (df.groupBy("building_id").agg(F.count(F.lit(1)).alias("_n"))
            .filter(F.col("_n") < min_records).select("building_id"))


def drop_sparse_buildings(df: DataFrame, min_records: int = S.MIN_RECORDS_PER_BUILDING) -> DataFrame:
    """Remove buildings with fewer than ``min_records`` rows (left semi join)."""
    return df.join(dense_buildings(df, min_records), on="building_id", how="left_semi")


# ---------------------------------------------------------------- chain
GONE, COPIES = "_gone", "_copies"
BROADCAST_MAX_ROWS = 1_000_000   # sparse buildings up to this number are broadcast


@dataclass
class CleanResult:
    """Clean records, and every record that went with the step (1 to 7) that it went at.

    ``checked`` holds all input rows after steps 1 to 3, ``finished`` the rows
    that passed those, one for each duplicate key.  Both are stored by
    ``clean``, so the report reads two narrow columns of them and no
    step runs again.  The marks are part of the rows, not counters beside
    the job: tasks that run twice after a loss cannot count twice.
    """

    checked: DataFrame
    finished: DataFrame

    @property
    def data(self) -> DataFrame:
        return self.finished.filter(F.col(GONE) == 0).drop(GONE, COPIES)

    def rejected(self) -> DataFrame:
        """Records that went at any step but the fifth, with ``stage`` and ``copies``.

        Records that broke a rule or were too old or of a sparse building
        appear once for a duplicate key; ``copies`` is then their number.
        """
        names = F.element_at(F.array(*[F.lit(s) for s in STAGES]), F.col(GONE))
        early = self.checked.withColumn(COPIES, F.lit(1).cast("long"))
        both = early.filter(F.col(GONE) > 0).unionByName(self.finished.filter(F.col(GONE) > 0))
        return both.withColumn("stage", names).withColumnRenamed(COPIES, "copies").drop(GONE)

    def report(self) -> DataFrame:
        """Rows removed per stage (A11), as one long table computed lazily."""
        def removed(df, steps):
            wide = df.agg(*[F.coalesce(F.sum(v), F.lit(0)).cast("long").alias(f"s{i}") for i, v in steps.items()])
            stack = ", ".join(f"{i}, s{i}" for i in steps)
            return wide.selectExpr(f"stack({len(steps)}, {stack}) AS (step, records_removed)")

        def gone(i, n=F.lit(1)):
            return F.when(F.col(GONE) == i, n).otherwise(0)

        early = removed(self.checked, {0: F.lit(-1), **{i: gone(i) for i in (1, 2, 3)}})
        late = removed(self.finished, {4: gone(4, F.col(COPIES)), 5: F.when(F.col(GONE) != 4, F.col(COPIES) - 1).otherwise(0),
                                       6: gone(6), 7: gone(7)})
        from pyspark.sql import Window
        w = Window.orderBy("step")   # 8 rows
        names = F.element_at(F.array(*[F.lit(s) for s in ["initial"] + STAGES]), F.col("step") + 1)
        return (early.unionByName(late)
                .select("step", names.alias("stage"), (-F.sum("records_removed").over(w)).alias("records_after"), "records_removed")
                .filter(F.col("step") > 0))


def _lacking(df: DataFrame, columns) -> Column:
    """What ``dropna`` drops: a null, or NaN in a floating column."""
    floating = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return reduce(lambda a, b: a | b, [F.col(c).isNull() | (F.isnan(c) if c in floating else F.lit(False)) for c in columns])


def _mark(df: DataFrame, step: int, bad: Column) -> DataFrame:
    return df.withColumn(GONE, F.when((F.col(GONE) == 0) & F.coalesce(bad, F.lit(True)), F.lit(step)).otherwise(F.col(GONE)))


def clean(df: DataFrame, as_of: str, tie=None, strict_nulls: bool = False,
          min_records: int = S.MIN_RECORDS_PER_BUILDING, max_age_days: int = S.MAX_AGE_DAYS,
          columns=S.RECORD_COLUMNS, checkpoint: bool = True) -> CleanResult:
    """The seven steps.  Rows that go are marked with their step and left out of the steps after it.

    Two writes (``checkpoint``): after step 3's filter, whose rows the fills read several times, and after step 6.
    The rows between them are marked in place, so that only what repeats or lacks a technician is shuffled whole;
    step 7 marks the stored rows by the sparse buildings as they are read, unless these are too many to broadcast.
    """
    df = ensure_required_columns(df).withColumn(GONE, F.lit(0))
    df = coerce_types(_mark(df, 1, _lacking(df, S.ESSENTIAL_COLUMNS)))
    df = _mark(df, 2, _lacking(df, S.TYPED_ESSENTIALS))
    checked = fill_downtime(_mark(df, 3, ~missing_share_ok(df, columns)))
    if checkpoint:
        checked = materialize(checked)
    df = fill_missing(checked.filter(F.col(GONE) == 0))
    df = _mark(df, 4, violation_flag(strict_nulls))
    first = drop_stored_duplicates if checkpoint else drop_duplicates_first
    df = first(df, key=[*S.DUPLICATE_KEY, GONE], tie=tie, copies=COPIES)
    df = _mark(df, 6, date_out_of_range(as_of, max_age_days))
    if checkpoint:
        df = materialize(df)
    sparse = sparse_buildings(df.filter(F.col(GONE) == 0), min_records)
    few = True
    if checkpoint:
        sparse = materialize(sparse)
        few = sparse.limit(BROADCAST_MAX_ROWS + 1).count() <= BROADCAST_MAX_ROWS
        sparse = F.broadcast(sparse) if few else sparse
    df = df.join(sparse.withColumn("_sparse", F.lit(True)), on="building_id", how="left")
    finished = _mark(df, 7, F.col("_sparse").isNotNull()).drop("_sparse").select(*checked.columns, COPIES)
    return CleanResult(checked, finished if few else materialize(finished))


def quality_score(clean_df: DataFrame, initial: DataFrame, columns=S.RECORD_COLUMNS) -> DataFrame:
    """Final data-quality score (A12): retention - 0.5*missing share + spread bonus."""
    cols = [c for c in columns if c in clean_df.columns]
    n0 = initial.agg(F.count(F.lit(1)).alias("initial_records"))
    agg = clean_df.agg(
        F.count(F.lit(1)).alias("final_records"),
        F.sum(null_count(cols)).alias("_nulls"),
        F.countDistinct("building_id").alias("buildings"),
        F.countDistinct("asset_type").alias("asset_types"))
    j = n0.withColumn("_k", F.lit(1)).join(agg.withColumn("_k", F.lit(1)), "_k")   # one row each
    retention = F.coalesce(F.try_divide(F.col("final_records").cast("double"), F.col("initial_records")), F.lit(0.0))
    missing = F.when(F.col("final_records") > 0,
                     F.col("_nulls") / (F.col("final_records") * F.lit(len(cols)))).otherwise(F.lit(0.0))
    bonus = F.when(F.col("final_records") > 100,
                   F.when(F.col("buildings") >= 10, 0.1).otherwise(0.0)
                   + F.when(F.col("asset_types") >= 3, 0.1).otherwise(0.0)).otherwise(0.0)
    score = F.least(F.lit(1.0), F.greatest(F.lit(0.0), retention - missing * 0.5 + bonus))
    return j.select("initial_records", "final_records",
                    (F.col("initial_records") - F.col("final_records")).alias("total_removed"),
                    retention.alias("retention_rate"), (missing * 100).alias("missing_pct"),
                    "buildings", "asset_types", score.alias("quality_score"))


def schema_report(df: DataFrame, required=S.REQUIRED_COLUMNS) -> DataFrame:
    """Validation report (A10): counts, missing share, rule errors, schema score."""
    types = {f.name: f.dataType for f in df.schema.fields}
    integral = (T.LongType, T.IntegerType, T.ShortType, T.ByteType)
    numeric = integral + (T.DoubleType, T.FloatType, T.DecimalType)
    static_errors = []
    missing = sorted(set(required) - set(df.columns))
    if missing:
        static_errors.append(f"Missing required columns: {missing}")
    if "building_id" in types and not isinstance(types["building_id"], integral):
        static_errors.append("building_id must be integer type")
    if "building_area" in types and not isinstance(types["building_area"], numeric):
        static_errors.append("building_area must be numeric type")
    if "building_floors" in types and not isinstance(types["building_floors"], integral):
        static_errors.append("building_floors must be integer type")
    present_required = [c for c in required if c in df.columns]
    check_cols = present_required if not missing else df.columns
    agg = df.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in check_cols])).alias("valid_records"),
        F.sum(null_count(df.columns)).alias("_nulls"),
        (F.count_if(F.col("building_area") <= 0) > 0 if "building_area" in types else F.lit(False)).alias("_bad_area"),
        (F.count_if(F.col("building_floors") <= 0) > 0 if "building_floors" in types else F.lit(False)).alias("_bad_floors"),
    )
    errors = F.concat(
        F.array(*[F.lit(e) for e in static_errors]).cast("array<string>"),
        F.when(F.col("_bad_area"), F.array(F.lit("building_area contains non-positive values")))
         .otherwise(F.array().cast("array<string>")),
        F.when(F.col("_bad_floors"), F.array(F.lit("building_floors contains non-positive values")))
         .otherwise(F.array().cast("array<string>")))
    pct = F.coalesce(F.try_divide(F.col("_nulls") * 100.0, F.col("total_records") * F.lit(len(df.columns))),
                     F.lit(0.0))
    return agg.select(
        "total_records", "valid_records",
        (F.col("total_records") - F.col("valid_records")).alias("invalid_records"),
        pct.alias("missing_data_percentage"),
        errors.alias("validation_errors"),
    ).withColumn("data_quality_score",
                 F.greatest(F.lit(0.0), F.lit(1.0) - (F.size("validation_errors") * 0.1
                                                      + F.col("missing_data_percentage") * 0.01)))


def record_contract_violations(df: DataFrame) -> DataFrame:
    """Rows breaking the per-record contract (area > 0, floors > 0, cost >= 0) (P10)."""
    c = F.col
    reasons = F.filter(F.array(
        F.when(c("building_area") <= 0, F.lit("building_area must be positive")),
        F.when(c("building_floors") <= 0, F.lit("building_floors must be positive")),
        F.when(c("maintenance_cost") < 0, F.lit("maintenance_cost cannot be negative"))),
        lambda x: x.isNotNull())
    return df.withColumn("violations", reasons).filter(F.size("violations") > 0)


REQUEST_REQUIRED = ["building_id", "building_type", "asset_type", "city", "country", "building_area",
                    "building_floors"]


def request_violations(requests: DataFrame) -> DataFrame:
    """Prediction requests breaking the request contract, with reasons.

    Required fields must be present, area and floors positive.  There is no
    batch-size cap: Spark scores any number of requests.
    """
    c = F.col
    checks = [F.when(c(f).isNull(), F.lit(f"{f} is required")) for f in REQUEST_REQUIRED if f in requests.columns]
    checks += [F.when(c(f) <= 0, F.lit(f"{f} must be positive"))
               for f in ("building_area", "building_floors") if f in requests.columns]
    missing = [f for f in REQUEST_REQUIRED if f not in requests.columns]
    checks += [F.lit(f"{f} is required") for f in missing]
    reasons = F.filter(F.array(*checks), lambda x: x.isNotNull())
    return requests.withColumn("violations", reasons).filter(F.size("violations") > 0)
