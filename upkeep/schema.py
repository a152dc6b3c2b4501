"""Record schemas and the fixed business constants.

The constants below are fixed values that must equal the behaviour being
reproduced (thresholds, bin edges, labels, feature lists).  They are kept
together, in natural order, and every operator takes them as overridable
parameters.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Canonical maintenance record
# ---------------------------------------------------------------------------
RECORD_SCHEMA = T.StructType([
    T.StructField("building_id", T.LongType(), True),
    T.StructField("building_type", T.StringType(), True),
    T.StructField("asset_type", T.StringType(), True),
    T.StructField("maintenance_type", T.StringType(), True),
    T.StructField("maintenance_date", T.TimestampType(), True),
    T.StructField("failure_reported", T.BooleanType(), True),
    T.StructField("downtime_days", T.LongType(), True),
    T.StructField("maintenance_cost", T.DoubleType(), True),
    T.StructField("technician_id", T.LongType(), True),
    T.StructField("period_days", T.LongType(), True),
    T.StructField("city", T.StringType(), True),
    T.StructField("country", T.StringType(), True),
    T.StructField("building_area", T.DoubleType(), True),
    T.StructField("building_floors", T.LongType(), True),
])
RECORD_COLUMNS = [f.name for f in RECORD_SCHEMA.fields]

# Raw (string-typed) landing schema: every field read as text, coerced later
# with try_cast so that one bad value nulls a cell instead of failing a file.
RAW_RECORD_SCHEMA = T.StructType([T.StructField(n, T.StringType(), True) for n in RECORD_COLUMNS])

PREDICTION_REQUEST_SCHEMA = T.StructType([
    T.StructField("building_id", T.LongType(), True),
    T.StructField("building_type", T.StringType(), True),
    T.StructField("asset_type", T.StringType(), True),
    T.StructField("city", T.StringType(), True),
    T.StructField("country", T.StringType(), True),
    T.StructField("building_area", T.DoubleType(), True),
    T.StructField("building_floors", T.LongType(), True),
    T.StructField("days_since_last_maintenance", T.LongType(), True),
    T.StructField("maintenance_frequency", T.DoubleType(), True),
    T.StructField("building_age_years", T.DoubleType(), True),
])

# Nested export document (metadata + arrays of records and dimensions).
_BUILDING = T.StructType([
    T.StructField("building_id", T.LongType()), T.StructField("building_name", T.StringType()),
    T.StructField("building_type", T.StringType()), T.StructField("address", T.StringType()),
    T.StructField("city", T.StringType()), T.StructField("country", T.StringType()),
    T.StructField("postal_code", T.StringType()), T.StructField("building_area", T.DoubleType()),
    T.StructField("building_floors", T.LongType()), T.StructField("construction_year", T.LongType()),
    T.StructField("total_units", T.LongType()),
])
_DOC_RECORD = T.StructType(
    [T.StructField("record_id", T.StringType())]
    + [T.StructField(n, T.StringType()) for n in RECORD_COLUMNS]
    + [T.StructField(n, T.StringType()) for n in (
        "asset_identifier", "technician_name", "work_description", "severity", "completion_status")]
)
_TECHNICIAN = T.StructType([
    T.StructField("technician_id", T.LongType()), T.StructField("name", T.StringType()),
    T.StructField("specializations", T.ArrayType(T.StringType())),
    T.StructField("experience_years", T.LongType()), T.StructField("certification_level", T.StringType()),
])
_CATEGORY = T.StructType([
    T.StructField("category", T.StringType()), T.StructField("description", T.StringType()),
    T.StructField("typical_maintenance_frequency_days", T.LongType()),
    T.StructField("average_cost_per_maintenance", T.DoubleType()),
    T.StructField("criticality", T.StringType()),
])
EXPORT_DOCUMENT_SCHEMA = T.StructType([
    T.StructField("metadata", T.StructType([
        T.StructField("export_date", T.StringType()), T.StructField("system_name", T.StringType()),
        T.StructField("version", T.StringType()), T.StructField("description", T.StringType()),
        T.StructField("data_period", T.StructType([
            T.StructField("start_date", T.StringType()), T.StructField("end_date", T.StringType())])),
        T.StructField("total_records", T.LongType()),
    ])),
    T.StructField("buildings", T.ArrayType(_BUILDING)),
    T.StructField("maintenance_records", T.ArrayType(_DOC_RECORD)),
    T.StructField("technicians", T.ArrayType(_TECHNICIAN)),
    T.StructField("asset_categories", T.ArrayType(_CATEGORY)),
])
# Descriptive per-record fields dropped on ingest.
DOC_DROP_COLUMNS = ["technician_name", "asset_identifier", "work_description", "severity",
                    "completion_status"]

# ---------------------------------------------------------------------------
# Fixed values (must match the behaviour being reproduced)
# ---------------------------------------------------------------------------
REQUIRED_COLUMNS = ["building_id", "building_type", "asset_type", "maintenance_type",
                    "maintenance_date", "failure_reported", "building_area", "building_floors"]
ESSENTIAL_COLUMNS = ["building_id", "building_type", "asset_type", "maintenance_date"]
TYPED_ESSENTIALS = ["building_id", "maintenance_date"]
DUPLICATE_KEY = ["building_id", "asset_type", "maintenance_date", "maintenance_type"]

MAX_MISSING_FRACTION = 0.3
MIN_RECORDS_PER_BUILDING = 10
MAX_AGE_DAYS = 3650          # oldest accepted record: as_of - 10*365 days
FUTURE_SLACK_DAYS = 1        # newest accepted record: as_of + 1 day
PERIOD_MIN_DAYS = 7
PERIOD_MAX_DAYS = 365
DEFAULT_PERIOD_DAYS = 90
DEFAULT_TECHNICIAN_ID = 1

PREDICTION_HORIZON_DAYS = 90  # 3 months x 30 days
OVERDUE_FACTOR = 1.2
DEFAULT_FREQUENCY = 2.0       # maintenances per year when history is too short
MIN_FREQUENCY_SPAN_DAYS = 30
DAYS_PER_YEAR = 365.25
ROLLING_ROWS = 3
AGE_REFERENCE_DATE = "2010-01-01"

COST_BINS = [(200.0, "low"), (500.0, "medium"), (1000.0, "high"), (float("inf"), "very_high")]
AREA_BINS = [(1000.0, "small"), (3000.0, "medium"), (6000.0, "large"), (float("inf"), "very_large")]
FLOOR_BINS = [(3.0, "low"), (7.0, "medium"), (15.0, "high"), (float("inf"), "very_high")]
SEASONS = {"winter": (12, 1, 2), "spring": (3, 4, 5), "summer": (6, 7, 8)}  # else autumn

LOW_RISK_THRESHOLD = 0.3
HIGH_RISK_THRESHOLD = 0.7
DECISION_THRESHOLD = 0.5
TIMEFRAME_STEPS = [(0.7, 30), (0.5, 60), (0.3, 90)]   # p > cut -> days
CONFIDENCE_FLOOR = 0.6
CONFIDENCE_CAP = 0.95
CONFIDENCE_SLOPE = 1.2

RULE_RISK_AGE_DAYS = 90
RULE_RISK_WEIGHTS = {"age": 0.3, "failure": 0.4, "critical_asset": 0.2, "high_cost": 0.1}
RULE_RISK_CRITICAL_ASSETS = ["elevator", "HVAC", "boiler"]

COST_FALSE_POSITIVE = 100.0
COST_FALSE_NEGATIVE = 1000.0
SAVING_TRUE_POSITIVE = 500.0
THRESHOLD_GRID = [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]
TEST_FRACTION = 0.2
SPLIT_SEED = 42
CV_FOLDS = 5
TUNING_FOLDS = 3
BOOTSTRAP_REPLICATES = 100
TREES = (100, 200, 300)   # tuning values for the number of trees or boosting rounds
CURVE_BINS = 100   # points of a bounded ROC / PR curve
HISTOGRAM_BINS = 30
ONE_HOT_MAX_CATEGORIES = 10

NUMERIC_FEATURES = ["building_area", "building_floors", "maintenance_cost", "downtime_days",
                    "period_days", "days_since_last_maintenance", "maintenance_frequency",
                    "building_age_years"]
CATEGORICAL_FEATURES = ["building_type", "asset_type", "maintenance_type", "city", "country",
                        "technician_id"]
ALWAYS_LABEL_ENCODED = ["technician_id", "building_id"]
ENGINEERED_CATEGORICALS = ["maintenance_cost_category", "building_size_category",
                           "building_height_category", "maintenance_season"]
ENGINEERED_NUMERIC = ["days_since_last_maintenance", "maintenance_frequency", "building_age_years",
                      "maintenance_cost_per_sqm", "downtime_cost_ratio", "building_failure_rate",
                      "asset_failure_rate", "preventive_effectiveness", "area_per_floor",
                      "asset_density", "city_building_count", "maintenance_cost_rolling_mean",
                      "downtime_rolling_mean", "cost_trend", "downtime_trend",
                      "cumulative_maintenance_cost", "cumulative_downtime", "maintenance_count"]
FINAL_EXCLUDE = ["building_id", "maintenance_date", "failure_reported", "building_type",
                 "asset_type", "maintenance_type", "city", "country", "maintenance_cost_category",
                 "building_size_category", "building_height_category", "maintenance_season"]
