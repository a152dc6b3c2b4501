"""DuckDB oracle SQL for the registered queries (same tables, plain SQL)."""

from __future__ import annotations

from upkeep.plans.oracle_base import DIRTY_CTE, RECORDS_CTE, TIE_SQL, with_ctes

REC_COLS = ["building_id", "building_type", "asset_type", "maintenance_type", "maintenance_date",
            "failure_reported", "downtime_days", "maintenance_cost", "technician_id", "period_days",
            "city", "country", "building_area", "building_floors"]
NULLS_14 = " + ".join(f"CAST({c} IS NULL AS INTEGER)" for c in REC_COLS)

BASE = with_ctes(RECORDS_CTE, DIRTY_CTE)


def median_cte(name, src, keys, col, out):
    part = f"PARTITION BY {keys}" if keys else ""
    sel = f"{keys}, " if keys else ""
    grp = f"GROUP BY {keys}" if keys else ""
    return f"""
{name} AS (
  SELECT {sel}(max(CASE WHEN rn = (n + 1) // 2 THEN v END)
             + max(CASE WHEN rn = n // 2 + 1 THEN v END)) / 2.0 AS {out}
  FROM (SELECT {sel}{col} AS v,
               row_number() OVER ({part} ORDER BY {col}) AS rn,
               count(*) OVER ({part}) AS n
        FROM {src} WHERE {col} IS NOT NULL) t
  {grp}
)"""


def mode_cte(name, src, keys, col, out, where="TRUE"):
    return f"""
{name} AS (
  SELECT {keys}, {col} AS {out} FROM (
    SELECT {keys}, {col}, row_number() OVER (PARTITION BY {keys} ORDER BY count(*) DESC, {col} ASC) AS rn
    FROM {src} WHERE {col} IS NOT NULL AND ({where}) GROUP BY {keys}, {col}) t
  WHERE rn = 1
)"""


RULES_ANY = """(coalesce(building_area <= 0, false) OR coalesce(building_floors <= 0, false)
   OR coalesce(maintenance_cost < 0, false) OR coalesce(downtime_days < 0, false)
   OR coalesce(failure_reported = false AND downtime_days > 1, false)
   OR coalesce(period_days < 7 OR period_days > 365, false))"""

RULES_STRICT = """coalesce(coalesce(building_area <= 0, false) OR building_floors <= 0
   OR coalesce(maintenance_cost < 0, false) OR downtime_days < 0
   OR (failure_reported = false AND downtime_days > 1)
   OR (period_days < 7 OR period_days > 365), true)"""


def clean_ctes(src="dirty", as_of="2001-12-01", max_age=3650, min_records=10):
    """CTE chain s1..s7 reproducing the seven cleaning stages."""
    return f"""
s1 AS (SELECT * FROM {src} WHERE building_id IS NOT NULL AND building_type IS NOT NULL
        AND asset_type IS NOT NULL AND maintenance_date IS NOT NULL),
s2 AS (SELECT * FROM s1 WHERE building_id IS NOT NULL AND maintenance_date IS NOT NULL),
m0 AS (SELECT * FROM s2 WHERE ({NULLS_14}) / 14.0 <= 0.3),
m1 AS (SELECT * REPLACE (CASE WHEN failure_reported = false THEN coalesce(downtime_days, 0)
                              ELSE downtime_days END AS downtime_days) FROM m0),
{median_cte('med_t', 'm1', 'asset_type', 'maintenance_cost', 'cost_median').strip()},
m2 AS (SELECT m1.* REPLACE (coalesce(m1.maintenance_cost, med_t.cost_median) AS maintenance_cost)
       FROM m1 LEFT JOIN med_t USING (asset_type)),
{median_cte('med_all', 'm2', '', 'maintenance_cost', 'cost_median').strip()},
m3 AS (SELECT m2.* REPLACE (coalesce(m2.maintenance_cost, (SELECT cost_median FROM med_all)) AS maintenance_cost)
       FROM m2),
{mode_cte('pmode', 'm3', 'asset_type', 'period_days', 'period_mode', "maintenance_type = 'preventive'").strip()},
m4 AS (SELECT m3.* REPLACE (CASE WHEN m3.maintenance_type = 'preventive' AND m3.period_days IS NULL
                                 THEN coalesce(pmode.period_mode, 90) ELSE m3.period_days END AS period_days)
       FROM m3 LEFT JOIN pmode USING (asset_type)),
{mode_cte('tmode', 'm4', 'building_id', 'technician_id', 'technician_mode').strip()},
s3 AS (SELECT m4.* REPLACE (coalesce(m4.technician_id, tmode.technician_mode, 1) AS technician_id)
       FROM m4 LEFT JOIN tmode USING (building_id)),
s4 AS (SELECT * FROM s3 WHERE NOT {RULES_ANY}),
s5 AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (
         PARTITION BY building_id, asset_type, maintenance_date, maintenance_type
         ORDER BY {TIE_SQL}) AS rn FROM s4) t WHERE rn = 1),
s6 AS (SELECT * FROM s5 WHERE NOT (maintenance_date > TIMESTAMP '{as_of}' + INTERVAL 1 DAY
                                   OR maintenance_date < TIMESTAMP '{as_of}' - INTERVAL {max_age} DAY)),
s7 AS (SELECT * FROM s6 WHERE building_id IN (
         SELECT building_id FROM s6 GROUP BY building_id HAVING count(*) >= {min_records}))"""


CLEAN = with_ctes(RECORDS_CTE, DIRTY_CTE, clean_ctes())

ORACLE = {
    "records": BASE + "SELECT * FROM records",
    "records_dirty": BASE + "SELECT * FROM dirty",
    "missing_filter": BASE + f"SELECT * FROM dirty WHERE ({NULLS_14}) / 14.0 <= 0.3",
    "fill_downtime": BASE + """SELECT * REPLACE (CASE WHEN failure_reported = false
        THEN coalesce(downtime_days, 0) ELSE downtime_days END AS downtime_days) FROM dirty""",
    "cost_median": with_ctes(RECORDS_CTE, DIRTY_CTE,
                             median_cte('med', 'dirty', 'asset_type', 'maintenance_cost', 'cost_median'))
    + "SELECT * FROM med WHERE asset_type IS NOT NULL",
    "cost_fill": with_ctes(RECORDS_CTE, DIRTY_CTE,
                           median_cte('med_t', 'dirty', 'asset_type', 'maintenance_cost', 'cost_median'),
                           """m2 AS (SELECT dirty.* REPLACE (coalesce(dirty.maintenance_cost, med_t.cost_median)
                                AS maintenance_cost) FROM dirty LEFT JOIN med_t USING (asset_type))""",
                           median_cte('med_all', 'm2', '', 'maintenance_cost', 'cost_median'))
    + "SELECT m2.* REPLACE (coalesce(m2.maintenance_cost, (SELECT cost_median FROM med_all)) AS maintenance_cost) FROM m2",
    "period_mode": with_ctes(RECORDS_CTE, DIRTY_CTE,
                             mode_cte('pm', 'dirty', 'asset_type', 'period_days', 'period_mode',
                                      "maintenance_type = 'preventive'")) + "SELECT * FROM pm",
    "technician_mode": with_ctes(RECORDS_CTE, DIRTY_CTE,
                                 mode_cte('tm', 'dirty', 'building_id', 'technician_id', 'technician_mode'))
    + "SELECT * FROM tm",
    "technician_fill": with_ctes(RECORDS_CTE, DIRTY_CTE,
                                 mode_cte('tm', 'dirty', 'building_id', 'technician_id', 'technician_mode'))
    + """SELECT dirty.* REPLACE (coalesce(dirty.technician_id, tm.technician_mode, 1) AS technician_id)
         FROM dirty LEFT JOIN tm USING (building_id)""",
    "rule_filter": BASE + f"SELECT * FROM dirty WHERE NOT {RULES_ANY}",
    "rule_filter_strict": BASE + f"SELECT * FROM dirty WHERE NOT {RULES_STRICT}",
    "rule_counts": BASE + f"""
SELECT rule, violations FROM (
  SELECT count_if(coalesce(building_area <= 0, false)) AS non_positive_area,
         count_if(coalesce(building_floors <= 0, false)) AS non_positive_floors,
         count_if(coalesce(maintenance_cost < 0, false)) AS negative_cost,
         count_if(coalesce(downtime_days < 0, false)) AS negative_downtime,
         count_if(coalesce(failure_reported = false AND downtime_days > 1, false)) AS downtime_without_failure,
         count_if(coalesce(period_days < 7 OR period_days > 365, false)) AS period_out_of_range,
         count_if({RULES_ANY}) AS any_rule
  FROM dirty) UNPIVOT (violations FOR rule IN (non_positive_area, non_positive_floors, negative_cost,
       negative_downtime, downtime_without_failure, period_out_of_range, any_rule))""",
    "dedup_first": with_ctes(RECORDS_CTE) + f"""
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (
  PARTITION BY building_id, asset_type, maintenance_date, maintenance_type ORDER BY {TIE_SQL}) AS rn
  FROM records) t WHERE rn = 1""",
    "date_range": with_ctes(RECORDS_CTE) + """
SELECT * FROM records WHERE NOT (maintenance_date > TIMESTAMP '2000-01-01' + INTERVAL 1 DAY
                                 OR maintenance_date < TIMESTAMP '2000-01-01' - INTERVAL 1460 DAY)""",
    "min_records": with_ctes(RECORDS_CTE) + """
SELECT * FROM records WHERE building_id IN (
  SELECT building_id FROM records GROUP BY building_id HAVING count(*) >= 10)""",
    "clean": CLEAN + "SELECT * FROM s7",
    "clean_report": CLEAN + """
SELECT CAST(step AS INTEGER) AS step, stage, records_after,
       CAST(lag(records_after) OVER (ORDER BY step) - records_after AS BIGINT) AS records_removed
FROM (
  SELECT 0 AS step, 'initial' AS stage, count(*) AS records_after FROM dirty
  UNION ALL SELECT 1, 'missing_columns', count(*) FROM s1
  UNION ALL SELECT 2, 'invalid_types', count(*) FROM s2
  UNION ALL SELECT 3, 'excessive_missing', count(*) FROM s3
  UNION ALL SELECT 4, 'business_logic', count(*) FROM s4
  UNION ALL SELECT 5, 'duplicates', count(*) FROM s5
  UNION ALL SELECT 6, 'invalid_dates', count(*) FROM s6
  UNION ALL SELECT 7, 'insufficient_building_data', count(*) FROM s7) t
QUALIFY step > 0""",
    "rejected_records": CLEAN + """
, late AS (SELECT s5.* EXCLUDE (maintenance_cost), CASE WHEN s6.l_orderkey IS NULL THEN 'invalid_dates' ELSE 'insufficient_building_data' END AS stage
           FROM s5 LEFT JOIN s6 USING (l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice)
           LEFT JOIN s7 USING (l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) WHERE s7.l_orderkey IS NULL),
steps AS (
  SELECT 'missing_columns' AS stage, building_id, 1 AS n FROM dirty UNION ALL SELECT 'missing_columns', building_id, -1 FROM s1
  UNION ALL SELECT 'invalid_types', building_id, 1 FROM s1 UNION ALL SELECT 'invalid_types', building_id, -1 FROM s2
  UNION ALL SELECT 'excessive_missing', building_id, 1 FROM s2 UNION ALL SELECT 'excessive_missing', building_id, -1 FROM s3
  UNION ALL SELECT 'business_logic', building_id, 1 FROM s3 UNION ALL SELECT 'business_logic', building_id, -1 FROM s4
  UNION ALL SELECT late.stage, s4.building_id, 1 FROM s4 JOIN late ON s4.building_id IS NOT DISTINCT FROM late.building_id
    AND s4.asset_type IS NOT DISTINCT FROM late.asset_type AND s4.maintenance_date IS NOT DISTINCT FROM late.maintenance_date
    AND s4.maintenance_type IS NOT DISTINCT FROM late.maintenance_type)
SELECT stage, building_id, CAST(sum(n) AS BIGINT) AS records FROM steps GROUP BY stage, building_id HAVING sum(n) > 0""",
    "quality_score": CLEAN + f"""
, agg AS (
  SELECT (SELECT count(*) FROM dirty) AS initial_records, count(*) AS final_records,
         CAST(sum({NULLS_14}) AS BIGINT) AS nulls,
         count(DISTINCT building_id) AS buildings, count(DISTINCT asset_type) AS asset_types
  FROM s7),
sc AS (
  SELECT *, CAST(final_records AS DOUBLE) / initial_records AS retention,
         CASE WHEN final_records > 0 THEN nulls / (final_records * 14.0) ELSE 0.0 END AS missing,
         CASE WHEN final_records > 100 THEN (CASE WHEN buildings >= 10 THEN 0.1 ELSE 0.0 END)
              + (CASE WHEN asset_types >= 3 THEN 0.1 ELSE 0.0 END) ELSE 0.0 END AS bonus
  FROM agg)
SELECT initial_records, final_records, initial_records - final_records AS total_removed,
       round(retention, 4) AS retention_rate, round(missing * 100, 4) AS missing_pct,
       buildings, asset_types,
       round(least(1.0, greatest(0.0, retention - missing * 0.5 + bonus)), 4) AS quality_score
FROM sc""",
    "schema_report": BASE + f"""
, agg AS (
  SELECT count(*) AS total_records,
         count_if(building_id IS NOT NULL AND building_type IS NOT NULL AND asset_type IS NOT NULL
                  AND maintenance_type IS NOT NULL AND maintenance_date IS NOT NULL
                  AND failure_reported IS NOT NULL AND building_area IS NOT NULL
                  AND building_floors IS NOT NULL) AS valid_records,
         sum({NULLS_14}) AS nulls,
         count_if(building_area <= 0) > 0 AS bad_area,
         count_if(building_floors <= 0) > 0 AS bad_floors
  FROM dirty),
r AS (
  SELECT total_records, valid_records, total_records - valid_records AS invalid_records,
         coalesce(nulls * 100.0 / (total_records * 14), 0.0) AS pct,
         list_filter([CASE WHEN bad_area THEN 'building_area contains non-positive values' END,
                      CASE WHEN bad_floors THEN 'building_floors contains non-positive values' END],
                     lambda x: x IS NOT NULL) AS errs
  FROM agg)
SELECT total_records, valid_records, invalid_records, round(pct, 4) AS missing_data_percentage,
       array_to_string(errs, '|') AS validation_errors,
       round(greatest(0.0, 1.0 - (len(errs) * 0.1 + pct * 0.01)), 4) AS data_quality_score
FROM r""",
    "contract_violations": BASE + """
SELECT * FROM (
  SELECT *, array_to_string(list_filter([
      CASE WHEN building_area <= 0 THEN 'building_area must be positive' END,
      CASE WHEN building_floors <= 0 THEN 'building_floors must be positive' END,
      CASE WHEN maintenance_cost < 0 THEN 'maintenance_cost cannot be negative' END],
      lambda x: x IS NOT NULL), '|') AS violations
  FROM dirty) t WHERE violations <> ''""",
}


def features_ctes(src="s7"):
    """Feature CTEs over a cleaned relation; final relation is ``feat``."""
    return f"""
g AS (SELECT building_id, asset_type, count(*) AS n,
             min(epoch_us(maintenance_date)) AS lo, max(epoch_us(maintenance_date)) AS hi,
             count_if(failure_reported) AS f, count(failure_reported) AS fn,
             count_if(maintenance_type = 'preventive' AND failure_reported) AS pf,
             count(CASE WHEN maintenance_type = 'preventive' THEN failure_reported END) AS pfn
      FROM {src} GROUP BY building_id, asset_type),
gb AS (SELECT building_id, CAST(sum(f) AS DOUBLE) / sum(fn) AS building_failure_rate,
              count(asset_type) AS asset_density FROM g GROUP BY building_id),
ga AS (SELECT asset_type, CAST(sum(f) AS DOUBLE) / sum(fn) AS asset_failure_rate FROM g GROUP BY asset_type),
gc AS (SELECT city, count(DISTINCT building_id) AS city_building_count FROM {src}
       WHERE city IS NOT NULL GROUP BY city),
gw AS (SELECT *,
         lag(maintenance_date) OVER win AS p_date, lead(maintenance_date) OVER win AS n_date,
         lag(maintenance_cost, 1) OVER win AS l1c, lag(maintenance_cost, 2) OVER win AS l2c,
         lag(downtime_days, 1) OVER win AS l1d, lag(downtime_days, 2) OVER win AS l2d,
         sum(CAST(maintenance_cost AS DECIMAL(24,6))) OVER (win ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cc,
         sum(downtime_days) OVER (win ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cd,
         row_number() OVER win AS rn
       FROM {src}
       WINDOW win AS (PARTITION BY building_id, asset_type ORDER BY maintenance_date, {TIE_SQL})),
gj AS (SELECT gw.*, g.n, g.lo, g.hi, g.pf, g.pfn, gb.building_failure_rate, gb.asset_density,
              ga.asset_failure_rate, gc.city_building_count,
              CAST(floor((epoch_us(maintenance_date) - epoch_us(p_date)) / 86400000000.0) AS BIGINT) AS gap,
              CAST(floor((epoch_us(n_date) - epoch_us(maintenance_date)) / 86400000000.0) AS BIGINT) AS to_next,
              floor((g.hi - g.lo) / 86400000000.0) AS span
       FROM gw JOIN g USING (building_id, asset_type) JOIN gb USING (building_id)
       JOIN ga USING (asset_type) LEFT JOIN gc USING (city)),
feat AS (SELECT * EXCLUDE (p_date, n_date, l1c, l2c, l1d, l2d, cc, cd, rn, n, lo, hi, pf, pfn, gap, to_next, span),
   to_next AS days_to_next_maintenance,
   coalesce(to_next <= 90 OR failure_reported = true OR (period_days IS NOT NULL AND gap > period_days * 1.2), false)
     AS maintenance_needed,
   coalesce(gap, period_days, 90) AS days_since_last_maintenance,
   CASE WHEN n < 2 OR span < 30 THEN 2.0 ELSE n / (span / 365.25) END AS maintenance_frequency,
   CAST(month(maintenance_date) AS INTEGER) AS maintenance_month,
   CAST(quarter(maintenance_date) AS INTEGER) AS maintenance_quarter,
   CAST(isodow(maintenance_date) - 1 AS INTEGER) AS maintenance_day_of_week,
   CASE WHEN month(maintenance_date) IN (12, 1, 2) THEN 'winter' WHEN month(maintenance_date) IN (3, 4, 5) THEN 'spring'
        WHEN month(maintenance_date) IN (6, 7, 8) THEN 'summer' ELSE 'autumn' END AS maintenance_season,
   CAST(floor((epoch_us(maintenance_date) - epoch_us(TIMESTAMP '2010-01-01')) / 86400000000.0) AS BIGINT) / 365.25
     AS building_age_years,
   coalesce(CASE WHEN building_area = 0 THEN NULL ELSE maintenance_cost / building_area END, 0.0) AS maintenance_cost_per_sqm,
   CASE WHEN maintenance_cost > 0 THEN CASE WHEN maintenance_cost <= 200 THEN 'low' WHEN maintenance_cost <= 500 THEN 'medium'
        WHEN maintenance_cost <= 1000 THEN 'high' ELSE 'very_high' END END AS maintenance_cost_category,
   CASE WHEN maintenance_cost + 1.0 = 0 THEN NULL ELSE CAST(downtime_days AS DOUBLE) / (maintenance_cost + 1.0) END
     AS downtime_cost_ratio,
   CASE WHEN maintenance_type = 'preventive' THEN 1.0 - CAST(pf AS DOUBLE) / pfn ELSE 0.0 END AS preventive_effectiveness,
   building_area / building_floors AS area_per_floor,
   CASE WHEN building_area > 0 THEN CASE WHEN building_area <= 1000 THEN 'small' WHEN building_area <= 3000 THEN 'medium'
        WHEN building_area <= 6000 THEN 'large' ELSE 'very_large' END END AS building_size_category,
   CASE WHEN building_floors > 0 THEN CASE WHEN building_floors <= 3 THEN 'low' WHEN building_floors <= 7 THEN 'medium'
        WHEN building_floors <= 15 THEN 'high' ELSE 'very_high' END END AS building_height_category,
   CASE WHEN (CAST(maintenance_cost IS NOT NULL AS INTEGER) + CAST(l1c IS NOT NULL AS INTEGER) + CAST(l2c IS NOT NULL AS INTEGER)) > 0
        THEN (coalesce(maintenance_cost, 0.0) + coalesce(l1c, 0.0) + coalesce(l2c, 0.0))
             / (CAST(maintenance_cost IS NOT NULL AS INTEGER) + CAST(l1c IS NOT NULL AS INTEGER) + CAST(l2c IS NOT NULL AS INTEGER)) END
     AS maintenance_cost_rolling_mean,
   CASE WHEN (CAST(downtime_days IS NOT NULL AS INTEGER) + CAST(l1d IS NOT NULL AS INTEGER) + CAST(l2d IS NOT NULL AS INTEGER)) > 0
        THEN (coalesce(CAST(downtime_days AS DOUBLE), 0.0) + coalesce(CAST(l1d AS DOUBLE), 0.0) + coalesce(CAST(l2d AS DOUBLE), 0.0))
             / (CAST(downtime_days IS NOT NULL AS INTEGER) + CAST(l1d IS NOT NULL AS INTEGER) + CAST(l2d IS NOT NULL AS INTEGER)) END
     AS downtime_rolling_mean,
   coalesce(maintenance_cost - l1c, 0.0) AS cost_trend,
   coalesce(CAST(downtime_days - l1d AS DOUBLE), 0.0) AS downtime_trend,
   CASE WHEN maintenance_cost IS NOT NULL THEN CAST(cc AS DOUBLE) END AS cumulative_maintenance_cost,
   CASE WHEN downtime_days IS NOT NULL THEN CAST(cd AS BIGINT) END AS cumulative_downtime,
   CAST(rn AS BIGINT) AS maintenance_count
 FROM gj)"""


FEATURES = with_ctes(RECORDS_CTE, DIRTY_CTE, clean_ctes(), features_ctes())

FEATURE_GROUPS = {
    "label": ["days_to_next_maintenance", "maintenance_needed"],
    "time_features": ["days_since_last_maintenance", "maintenance_frequency", "maintenance_month",
                      "maintenance_quarter", "maintenance_day_of_week", "maintenance_season",
                      "building_age_years"],
    "maintenance_features": ["maintenance_cost_per_sqm", "maintenance_cost_category", "downtime_cost_ratio",
                             "building_failure_rate", "asset_failure_rate", "preventive_effectiveness"],
    "building_features": ["area_per_floor", "building_size_category", "building_height_category",
                          "asset_density", "city_building_count"],
    "aggregation_features": ["maintenance_cost_rolling_mean", "downtime_rolling_mean", "cost_trend",
                             "downtime_trend", "cumulative_maintenance_cost", "cumulative_downtime",
                             "maintenance_count"],
}
ID_COLS = ["building_id", "asset_type", "maintenance_date", "l_orderkey", "l_linenumber", "l_partkey",
           "l_suppkey", "l_extendedprice"]

ORACLE["features"] = FEATURES + "SELECT * FROM feat"
for _name, _cols in FEATURE_GROUPS.items():
    ORACLE[_name] = FEATURES + f"SELECT {', '.join(ID_COLS + _cols)} FROM feat"


# ------------------------------------------------------------------ encoding
# Category domains of the benchmark tables (fixed by the generator): the
# one-hot columns of the oracle are spelled out from them.
ONEHOT_DOMAINS = {
    "building_type": ["automobile", "building", "furniture", "household", "machinery"],
    "asset_type": ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD", "elevator"],
    "maintenance_type": ["corrective", "emergency", "preventive"],
    "country": ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"],
}
LABEL_ENCODED = ["city", "technician_id", "maintenance_cost_category", "building_size_category",
                 "building_height_category", "maintenance_season"]
SCALED = ["building_area", "building_floors", "maintenance_cost", "downtime_days", "period_days",
          "days_since_last_maintenance", "maintenance_frequency", "building_age_years",
          "maintenance_cost_per_sqm", "downtime_cost_ratio", "building_failure_rate",
          "asset_failure_rate", "preventive_effectiveness", "area_per_floor", "asset_density",
          "city_building_count", "maintenance_cost_rolling_mean", "downtime_rolling_mean", "cost_trend",
          "downtime_trend", "cumulative_maintenance_cost", "cumulative_downtime", "maintenance_count"]
UNSCALED = ["maintenance_month", "maintenance_quarter", "maintenance_day_of_week"]


def encoding_ctes():
    vocab = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS value FROM feat WHERE {c} IS NOT NULL"
        for c in LABEL_ENCODED)
    scal = ", ".join(f"avg({c}) AS m_{c}, CASE WHEN stddev_pop({c}) = 0 OR stddev_pop({c}) IS NULL THEN 1.0 "
                     f"ELSE stddev_pop({c}) END AS s_{c}" for c in SCALED)
    sel = []
    for c in SCALED:
        sel.append(f"round(coalesce((CAST(f.{c} AS DOUBLE) - sc.m_{c}) / sc.s_{c}, 0.0), 6) AS {c}")
    for c in UNSCALED:
        sel.append(f"CAST({c} AS DOUBLE) AS {c}")
    for c, vals in ONEHOT_DOMAINS.items():
        for v in vals:
            sel.append(f"CASE WHEN f.{c} = '{v}' THEN 1.0 ELSE 0.0 END AS \"{c}_{v}\"")
    joins = []
    for i, c in enumerate(LABEL_ENCODED):
        sel.append(f"CAST(coalesce(v{i}.code, -1) AS DOUBLE) AS {c}_encoded")
        joins.append(f"LEFT JOIN vocab v{i} ON v{i}.feature = '{c}' AND v{i}.value = CAST(f.{c} AS VARCHAR)")
    return f"""
vocab AS (SELECT feature, value, CAST(row_number() OVER (PARTITION BY feature ORDER BY value) - 1 AS BIGINT) AS code
          FROM (SELECT DISTINCT feature, value FROM ({vocab}) u) d),
sc AS (SELECT {scal} FROM feat),
matrix AS (SELECT f.building_id, f.asset_type, f.maintenance_date, f.l_orderkey, f.l_linenumber, f.l_partkey,
                  f.l_suppkey, f.l_extendedprice, f.maintenance_needed, {', '.join(sel)}
           FROM feat f CROSS JOIN sc {' '.join(joins)})"""


ENCODED = FEATURES.rstrip() + "," + encoding_ctes() + "\n"
MATRIX_COLS = (SCALED + UNSCALED + [f"{c}_{v}" for c, vals in ONEHOT_DOMAINS.items() for v in vals]
               + [f"{c}_encoded" for c in LABEL_ENCODED])

ORACLE["label_vocab"] = ENCODED + "SELECT * FROM vocab"
ORACLE["scaler_stats"] = ENCODED + "SELECT feature, round(mean, 6) AS mean, round(scale, 6) AS scale FROM (" + \
    " UNION ALL ".join(f"SELECT '{c}' AS feature, m_{c} AS mean, s_{c} AS scale FROM sc" for c in SCALED) + ") t"
ORACLE["encoder_roundtrip"] = ENCODED + "SELECT 'code' AS kind, feature, value, code, CAST(NULL AS DOUBLE) AS mean, CAST(NULL AS DOUBLE) AS scale FROM vocab" + \
    "".join(f" UNION ALL SELECT 'onehot', '{c}', value, row_number() OVER (ORDER BY value) - 1, NULL, NULL FROM (SELECT DISTINCT {c} AS value FROM feat WHERE {c} IS NOT NULL)"
            for c in ONEHOT_DOMAINS) + \
    "".join(f" UNION ALL SELECT 'scaler', '{c}', NULL, NULL, round(m_{c}, 6), round(s_{c}, 6) FROM sc" for c in SCALED)
ORACLE["encode_new"] = with_ctes(RECORDS_CTE) + """
, known AS (SELECT * FROM records WHERE country <> 'EUROPE'),
city_code AS (SELECT city, row_number() OVER (ORDER BY city) - 1 AS code FROM (SELECT DISTINCT city FROM known)),
tech_code AS (SELECT technician_id, row_number() OVER (ORDER BY CAST(technician_id AS VARCHAR)) - 1 AS code FROM (SELECT DISTINCT technician_id FROM known)),
area AS (SELECT avg(building_area) AS m, stddev_pop(building_area) AS s FROM known)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, building_id,
       coalesce(c.code, -1) AS city_encoded, coalesce(t.code, -1) AS technician_id_encoded,
       CASE WHEN country = 'AFRICA' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS "country_AFRICA", CASE WHEN country = 'AMERICA' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS "country_AMERICA",
       CASE WHEN country = 'ASIA' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS "country_ASIA", CASE WHEN country = 'MIDDLE EAST' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS "country_MIDDLE EAST",
       round((building_area - area.m) / area.s, 6) AS building_area
FROM records r LEFT JOIN city_code c ON r.city = c.city LEFT JOIN tech_code t ON r.technician_id = t.technician_id CROSS JOIN area"""
ORACLE["feature_matrix"] = ENCODED + "SELECT * FROM matrix"
ORACLE["feature_stats"] = ENCODED + "SELECT feature, round(mean, 6) AS mean, round(std, 6) AS std, " \
    "round(min, 6) AS min, round(max, 6) AS max FROM (" + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, avg(\"{c}\") AS mean, stddev_samp(\"{c}\") AS std, "
        f"CAST(min(\"{c}\") AS DOUBLE) AS min, CAST(max(\"{c}\") AS DOUBLE) AS max FROM matrix"
        for c in MATRIX_COLS) + ") t"


# ------------------------------------------------------------------ scoring / evaluation
import math  # noqa: E402

D = "CAST({} AS DOUBLE)".format
SCORE_FEATURES = ["maintenance_cost", "downtime_days", "days_since_last_maintenance",
                  "maintenance_frequency", "building_area", "maintenance_count"]
IDS = ", ".join(ID_COLS)


def _ratio(num, den):
    return f"coalesce(CASE WHEN ({den}) = 0 THEN NULL ELSE CAST({num} AS DOUBLE) / ({den}) END, 0.0)"


SCORED_CTES = f"""
mc AS (SELECT avg(maintenance_cost) AS m FROM feat),
risk AS (SELECT *, least((((({D('0.0')}
      + CASE WHEN floor((epoch_us(TIMESTAMP '2001-12-01') - epoch_us(maintenance_date)) / 86400000000.0) > 90
             THEN {D('0.3')} ELSE {D('0.0')} END)
      + CASE WHEN failure_reported = true THEN {D('0.4')} ELSE {D('0.0')} END)
      + CASE WHEN asset_type IN ('elevator', 'HVAC', 'boiler') THEN {D('0.2')} ELSE {D('0.0')} END)
      + CASE WHEN maintenance_cost > (SELECT m FROM mc) THEN {D('0.1')} ELSE {D('0.0')} END), {D('1.0')}) AS risk_score
    FROM feat),
mixed AS (SELECT *, (CAST(round(risk_score * 10) AS BIGINT) * 200
      + CAST(('0x' || substr(md5(concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey, 'score')), 1, 4)) AS BIGINT) % 1001 * 3)
      / CAST(5000 AS DOUBLE) AS mixed_score FROM risk),
scored AS (SELECT {IDS}, maintenance_needed AS label, mixed_score AS score, risk_score,
       CAST(mixed_score >= 0.5 AS INTEGER) AS prediction,
       CASE WHEN risk_score < 0.3 THEN 'LOW' WHEN risk_score < 0.7 THEN 'MEDIUM' ELSE 'HIGH' END AS risk_level,
       {', '.join(SCORE_FEATURES)}, concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS row_id
    FROM mixed),
cm AS (SELECT count_if(label AND prediction = 1) AS tp, count_if(NOT label AND prediction = 1) AS fp,
              count_if(NOT label AND prediction = 0) AS tn, count_if(label AND prediction = 0) AS fn FROM scored),
met AS (SELECT *, {_ratio('tp + tn', 'tp + fp + tn + fn')} AS accuracy, {_ratio('tp', 'tp + fp')} AS precision,
               {_ratio('tp', 'tp + fn')} AS recall, {_ratio('2 * tp', '2 * tp + fp + fn')} AS f1_score,
               {_ratio('tn', 'tn + fp')} AS specificity, {_ratio('tp', 'tp + fn')} AS sensitivity,
               {_ratio('fp', 'fp + tn')} AS false_positive_rate, {_ratio('fn', 'fn + tp')} AS false_negative_rate
        FROM cm),
sc_counts AS (SELECT CAST(score AS DOUBLE) AS threshold, count_if(label) AS tp_at, count_if(NOT label) AS fp_at
              FROM scored GROUP BY 1),
curve AS (SELECT threshold, tp_at, fp_at,
            CAST(sum(tp_at) OVER (ORDER BY threshold DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS tp,
            CAST(sum(fp_at) OVER (ORDER BY threshold DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS fp,
            CAST(sum(tp_at) OVER () AS BIGINT) AS pos, CAST(sum(fp_at) OVER () AS BIGINT) AS neg
          FROM sc_counts),
aucs AS (SELECT {_ratio('sum(fp_at * (2 * tp - tp_at))', '2 * first(pos) * first(neg)')} AS roc_auc,
                {_ratio('sum(CASE WHEN tp + fp > 0 THEN CAST(tp_at AS DOUBLE) * tp / (tp + fp) ELSE 0.0 END)', 'first(pos)')}
                  AS avg_precision
         FROM curve)"""

SCORED = FEATURES.rstrip() + "," + SCORED_CTES + "\n"


def _round_cols(cols, digits=6):
    return ", ".join(f"round({c}, {digits}) AS {c}" for c in cols)


MET_COLS = ["accuracy", "precision", "recall", "f1_score", "specificity", "sensitivity",
            "false_positive_rate", "false_negative_rate"]
THRESHOLDS = [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]
SWEEP = f"""
sweep AS (SELECT t.threshold,
   {_ratio('count_if(s.label AND s.score >= t.threshold)', 'count_if(s.score >= t.threshold)')} AS precision,
   {_ratio('count_if(s.label AND s.score >= t.threshold)', 'count_if(s.label)')} AS recall,
   {_ratio('2 * count_if(s.label AND s.score >= t.threshold)', 'count_if(s.score >= t.threshold) + count_if(s.label)')} AS f1_score
  FROM scored s CROSS JOIN (SELECT CAST(unnest([{', '.join(map(str, THRESHOLDS))}]) AS DOUBLE) AS threshold) t
  GROUP BY t.threshold)"""


def _poisson_sql(u):
    cdf, term, parts = 0.0, math.exp(-1.0), []
    for k in range(12):
        cdf += term
        term /= (k + 1)
        parts.append(f"WHEN {u} < {D(repr(cdf))} THEN {k}")
    return "CASE " + " ".join(parts) + " ELSE 12 END"


SPLIT = """
su AS (SELECT *, CAST(('0x' || substr(md5(concat_ws('|', row_id, 42)), 1, 13)) AS BIGINT) / 4503599627370496.0 AS uu
       FROM scored),
srk AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY uu, row_id) AS rnk,
               count(*) OVER (PARTITION BY label) AS n FROM su),
test_rows AS (SELECT * EXCLUDE (uu, rnk, n) FROM srk WHERE rnk <= round(n * 0.2)),"""
BOOT_AUC = """
, boot_s AS (SELECT rep, score, sum(CASE WHEN label THEN w ELSE 0 END) AS p, sum(CASE WHEN NOT label THEN w ELSE 0 END) AS n FROM boot_w GROUP BY rep, score),
boot_c AS (SELECT *, sum(n) OVER (PARTITION BY rep ORDER BY score) AS up FROM boot_s),
boot_auc AS (SELECT CAST(rep AS INTEGER) AS replicate, CAST(sum(p) AS BIGINT) AS pos, CAST(sum(n) AS BIGINT) AS neg,
                    CASE WHEN sum(p) * sum(n) > 0 THEN sum(p * (2 * up - n)) / CAST(2 * sum(p) * sum(n) AS DOUBLE) ELSE 0.0 END AS roc_auc
             FROM boot_c GROUP BY rep)"""
BOOT = SPLIT + f"""
boot_h AS (SELECT s.label, s.prediction, s.score, k.k, sha256(concat_ws('|', s.row_id, 42, k.k)) AS h
           FROM test_rows s CROSS JOIN (SELECT range AS k FROM range(25)) k),
boot_u AS (SELECT label, prediction, score, k * 4 + j AS rep,
                  CAST(('0x' || substr(h, 1 + 13 * j, 13)) AS BIGINT) / 4503599627370496.0 AS u
           FROM boot_h CROSS JOIN (SELECT range AS j FROM range(4)) jj),
boot_w AS (SELECT rep, label, prediction, score, {_poisson_sql('u')} AS w FROM boot_u),
boot AS (SELECT CAST(rep AS INTEGER) AS replicate,
                CAST(sum(CASE WHEN label AND prediction = 1 THEN w ELSE 0 END) AS BIGINT) AS tp,
                CAST(sum(CASE WHEN NOT label AND prediction = 1 THEN w ELSE 0 END) AS BIGINT) AS fp,
                CAST(sum(CASE WHEN label AND prediction = 0 THEN w ELSE 0 END) AS BIGINT) AS fn
         FROM boot_w GROUP BY rep)"""

EVAL = {
    "rule_risk": SCORED + f"SELECT {IDS}, risk_score AS score, risk_level FROM scored",
    "data_summary": CLEAN + """SELECT count(*) AS total_records, count(DISTINCT building_id) AS buildings,
        array_to_string(list_sort(list_distinct(list(country))), ', ') AS countries,
        array_to_string(list_sort(list_distinct(list(asset_type))), ', ') AS asset_types,
        strftime(min(maintenance_date), '%Y-%m-%d') AS first_date, strftime(max(maintenance_date), '%Y-%m-%d') AS last_date,
        round(avg(maintenance_cost), 4) AS avg_cost, CAST(round(sum(CAST(maintenance_cost AS DECIMAL(24,6))), 4) AS DOUBLE) AS total_cost,
        round(count_if(failure_reported) * 100.0 / count(*), 4) AS failure_rate_pct FROM s7""",
    "asset_distribution": CLEAN + "SELECT asset_type, count(*) AS records FROM s7 GROUP BY asset_type",
    "risk_outputs": SCORED + f"""SELECT {IDS}, round(score, 6) AS maintenance_probability,
        CASE WHEN score < 0.3 THEN 'low' WHEN score < 0.7 THEN 'medium' ELSE 'high' END AS risk_category,
        CAST(CASE WHEN score > 0.7 THEN 30 WHEN score > 0.5 THEN 60 WHEN score > 0.3 THEN 90 END AS BIGINT)
          AS predicted_timeframe_days,
        round(least(0.95, greatest(0.6, score * 1.2)), 6) AS confidence_score FROM scored""",
    "eval_metrics": SCORED + f"SELECT tp, fp, tn, fn, {_round_cols(MET_COLS)} FROM met",
    "classification_report": SCORED + f"""
, cls AS (
  SELECT '0' AS class, {_ratio('tn', 'tn + fn')} AS precision, {_ratio('tn', 'tn + fp')} AS recall,
         {_ratio('2 * tn', '2 * tn + fn + fp')} AS f1_score, CAST(tn + fp AS DOUBLE) AS support FROM cm
  UNION ALL
  SELECT '1', {_ratio('tp', 'tp + fp')}, {_ratio('tp', 'tp + fn')}, {_ratio('2 * tp', '2 * tp + fp + fn')},
         CAST(tp + fn AS DOUBLE) FROM cm),
rep AS (
  SELECT * FROM cls
  UNION ALL SELECT 'accuracy', accuracy, accuracy, accuracy, CAST(tp + fp + tn + fn AS DOUBLE) FROM met
  UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1_score), sum(support) FROM cls
  UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
                   sum(f1_score * support) / sum(support), sum(support) FROM cls)
SELECT class, {_round_cols(['precision', 'recall', 'f1_score', 'support'])} FROM rep""",
    "threshold_sweep": SCORED.rstrip() + "," + SWEEP + f"\nSELECT threshold, {_round_cols(['precision', 'recall', 'f1_score'])} FROM sweep",
    "best_threshold": SCORED.rstrip() + "," + SWEEP + """
SELECT threshold AS optimal_threshold, round(f1_score, 6) AS optimal_f1_score
FROM sweep ORDER BY f1_score DESC, threshold ASC LIMIT 1""",
    "error_patterns": SCORED + f"""
, errs AS (SELECT *, CASE WHEN NOT label AND prediction = 1 THEN 'false_positive'
                          WHEN label AND prediction = 0 THEN 'false_negative' END AS error_kind FROM scored),
wide AS (SELECT error_kind, count(*) AS errors, {', '.join(f'avg(CAST({c} AS DOUBLE)) AS {c}' for c in SCORE_FEATURES)}
         FROM errs WHERE error_kind IS NOT NULL GROUP BY error_kind),
long AS (SELECT error_kind, errors, feature, mean FROM wide
         UNPIVOT (mean FOR feature IN ({', '.join(SCORE_FEATURES)})))
SELECT error_kind, errors, feature, round(mean, 6) AS mean,
       CAST(row_number() OVER (PARTITION BY error_kind ORDER BY mean DESC NULLS LAST, feature) AS INTEGER) AS rank
FROM long""",
    "business_impact": SCORED + f"""
SELECT tp + fp + tn + fn AS total_predictions, tp + fp AS maintenance_predicted, tp + fn AS actual_maintenance_needed,
       tp AS correctly_predicted_maintenance, fn AS missed_maintenance_opportunities, fp AS unnecessary_maintenance_alerts,
       round(fp * 100.0, 6) AS false_positive_cost, round(fn * 1000.0, 6) AS false_negative_cost,
       round(tp * 500.0, 6) AS true_positive_savings, round(tp * 500.0 - fp * 100.0 - fn * 1000.0, 6) AS net_benefit,
       round({_ratio('tp', 'tp + fp')}, 6) AS maintenance_precision, round({_ratio('tp', 'tp + fn')}, 6) AS maintenance_recall,
       round({_ratio('tp + tn', 'tp + tn + fp + fn')}, 6) AS alert_accuracy FROM cm""",
    "roc_points": SCORED + f"""SELECT threshold, round({_ratio('fp', 'neg')}, 6) AS fpr,
        round({_ratio('tp', 'pos')}, 6) AS tpr FROM curve""",
    "pr_points": SCORED + f"""SELECT threshold, round({_ratio('tp', 'tp + fp')}, 6) AS precision,
        round({_ratio('tp', 'pos')}, 6) AS recall FROM curve""",
    "auc_ap": SCORED + "SELECT round(roc_auc, 6) AS roc_auc, round(avg_precision, 6) AS avg_precision FROM aucs",
    "probability_histogram": SCORED + """
SELECT CAST(label AS INTEGER) AS class, CAST(least(29, greatest(0, floor(score * 30))) AS INTEGER) AS bin,
       count(*) AS count, CAST(least(29, greatest(0, floor(score * 30))) AS INTEGER) / 30.0 AS bin_start
FROM scored GROUP BY 1, 2""",
    "confusion_cells": SCORED + """SELECT CAST(label AS INTEGER) AS actual, prediction AS predicted, count(*) AS count
        FROM scored GROUP BY 1, 2""",
    "model_comparison": SCORED + """
SELECT 'rule_risk' AS model, metric, round(value, 6) AS value FROM (
  SELECT accuracy, precision, recall, f1_score, roc_auc FROM met CROSS JOIN aucs)
UNPIVOT (value FOR metric IN (accuracy, precision, recall, f1_score, roc_auc))""",
    "bootstrap_f1": SCORED.rstrip() + "," + BOOT + f"""
SELECT replicate, tp, fp, fn, round({_ratio('2 * tp', '2 * tp + fp + fn')}, 6) AS f1_score FROM boot""",
    "bootstrap_auc": SCORED.rstrip() + "," + BOOT + BOOT_AUC + "\nSELECT replicate, pos, neg, round(roc_auc, 6) AS roc_auc FROM boot_auc",
    "stability": SCORED.rstrip() + "," + BOOT + BOOT_AUC + f"""
, vals AS (SELECT 'f1_score' AS metric, {_ratio('2 * tp', '2 * tp + fp + fn')} AS v FROM boot UNION ALL SELECT 'roc_auc', roc_auc FROM boot_auc)
SELECT metric, round(avg(v), 6) AS mean, round(stddev_pop(v), 6) AS std, round(min(v), 6) AS min, round(max(v), 6) AS max,
       round(quantile_cont(v, 0.025), 6) AS ci_low, round(quantile_cont(v, 0.975), 6) AS ci_high FROM vals GROUP BY metric""",
    "binned_curve": SCORED + f"""
, edges AS (SELECT range / 100.0::DOUBLE AS threshold FROM range(100)),
bc AS (SELECT e.threshold, count_if(s.label AND (s.score >= e.threshold OR e.threshold = 0)) AS tp, count_if(NOT s.label AND (s.score >= e.threshold OR e.threshold = 0)) AS fp,
              count_if(s.label) AS pos, count_if(NOT s.label) AS neg
       FROM edges e CROSS JOIN scored s GROUP BY e.threshold)
SELECT threshold, tp, fp, round({_ratio('fp', 'neg')}, 6) AS fpr, round({_ratio('tp', 'pos')}, 6) AS tpr, round({_ratio('tp', 'tp + fp')}, 6) AS precision FROM bc""",
    "cv_folds": SCORED.rstrip() + "," + SPLIT + """
tr AS (SELECT label, least(14, floor(CAST(('0x' || substr(md5(concat_ws('|', row_id, 'fold42')), 1, 13)) AS BIGINT) / 4503599627370496.0 * 15))::INTEGER AS fold
       FROM srk WHERE rnk > round(n * 0.2)),
cw AS (SELECT label, (SELECT count(*) FROM tr) / (2.0::DOUBLE * count(*)) AS balanced FROM tr GROUP BY label)
SELECT fold, CAST(tr.label AS INTEGER) AS label, count(*) AS n, round(max(balanced), 6) AS balanced,
       CASE WHEN tr.label THEN 2.0::DOUBLE ELSE 1.0 END AS two, CASE WHEN tr.label THEN 3.0::DOUBLE ELSE 1.0 END AS three
FROM tr JOIN cw ON tr.label = cw.label GROUP BY fold, tr.label""",
    "model_roundtrip": SCORED.rstrip() + "," + SPLIT.rstrip().rstrip(",") + """
SELECT CAST(label AS INTEGER) AS label, count(*) AS n, count(*) AS probabilities, count(*) AS decided, count(*) AS risks, count(*) AS same
FROM srk WHERE rnk <= round(n * 0.2) GROUP BY label""",
    "summary_values": CLEAN + """SELECT 'country' AS feature, country AS value, count(*) AS rows FROM s7 WHERE country IS NOT NULL GROUP BY country
UNION ALL SELECT 'asset_type', asset_type, count(*) FROM s7 GROUP BY asset_type""",
    "prediction_history": SCORED + f"""
SELECT building_id, asset_type, date_trunc('year', maintenance_date)::TIMESTAMP AS prediction_date, run_id, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
       round(score, 6) AS maintenance_probability, CASE WHEN score < 0.3 THEN 'low' WHEN score < 0.7 THEN 'medium' ELSE 'high' END AS risk_category
FROM scored CROSS JOIN (SELECT unnest(['a', 'b']) AS run_id) WHERE building_id = (SELECT min(building_id) FROM scored)""",
    "stratified_split": SCORED + f"""
, u AS (SELECT {IDS}, label, CAST(('0x' || substr(md5(concat_ws('|', row_id, 42)), 1, 13)) AS BIGINT) / 4503599627370496.0 AS uu,
               row_id FROM scored),
rk AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY uu, row_id) AS rnk, count(*) OVER (PARTITION BY label) AS n FROM u)
SELECT {IDS}, label, rnk <= round(n * 0.2) AS is_test FROM rk""",
}
ORACLE.update(EVAL)


# ------------------------------------------------------------------ operational extract
OPERATIONAL_CTES = """
buildings AS (SELECT c.c_custkey AS id, c.c_mktsegment AS type, 1500.0 + c.c_acctbal AS area,
                     CAST(1 + c.c_custkey % 25 AS BIGINT) AS number_of_floors, c.c_nationkey AS city_id,
                     n.n_regionkey AS country_id,
                     CASE WHEN c.c_custkey % 50 = 0 THEN TIMESTAMP '2000-01-01' END AS deleted_at
              FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey),
building_types AS (SELECT DISTINCT c_mktsegment AS code, lower(c_mktsegment) AS name FROM customer),
cities AS (SELECT n_nationkey AS id, n_name AS name FROM nation),
countries AS (SELECT r_regionkey AS id, r_name AS name FROM region),
services AS (SELECT p_partkey AS id, p_type AS title, CASE WHEN p_size > 45 THEN TIMESTAMP '2000-01-01' END AS deleted_at
             FROM part),
lo AS (SELECT * FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
building_service_technician AS (SELECT o_custkey AS building_id, l_partkey AS service_id, min(l_suppkey) AS user_id,
                                       CAST(30 * (1 + l_partkey % 4) AS BIGINT) AS period_days
                                FROM lo GROUP BY o_custkey, l_partkey),
recurring_services AS (SELECT l_partkey AS service_id, o_custkey AS building_id,
                              CASE WHEN l_linenumber <> 7 THEN l_shipdate END AS checked_date FROM lo),
reports AS (SELECT o_orderkey AS id, o_custkey AS building_id, o_orderdate AS created_at FROM orders
            WHERE o_orderstatus = 'F'),
building_resident AS (SELECT o_orderkey AS resident_id, o_custkey AS building_id FROM orders),
resident_invoice AS (SELECT o_orderkey AS resident_id, o_totalprice / 100.0 AS value FROM orders
                     UNION ALL SELECT o_orderkey, o_totalprice / 50.0 FROM orders WHERE o_orderkey % 3 = 0)"""

EXTRACT_SELECT = """
SELECT b.id AS building_id, bt.name AS building_type, s.title AS asset_type, 'preventive' AS maintenance_type,
       rs.checked_date AS maintenance_date,
       coalesce((SELECT max(r.created_at) FROM reports r WHERE r.building_id = b.id)
                >= rs.checked_date - INTERVAL 30 DAY, false) AS failure_reported,
       CAST(0 AS BIGINT) AS downtime_days, CAST(coalesce(ri.value, 0) AS DOUBLE) AS maintenance_cost,
       CAST(bst.user_id AS BIGINT) AS technician_id, CAST(bst.period_days AS BIGINT) AS period_days,
       c.name AS city, co.name AS country, CAST(b.area AS DOUBLE) AS building_area,
       CAST(b.number_of_floors AS BIGINT) AS building_floors
FROM buildings b
LEFT JOIN building_types bt ON b.type = bt.code
LEFT JOIN building_service_technician bst ON b.id = bst.building_id
LEFT JOIN services s ON bst.service_id = s.id
LEFT JOIN recurring_services rs ON s.id = rs.service_id AND b.id = rs.building_id
LEFT JOIN (SELECT resident_id, min(value) AS value FROM resident_invoice GROUP BY resident_id) ri ON ri.resident_id = (SELECT min(br.resident_id) FROM building_resident br
                                                   WHERE br.building_id = b.id)
LEFT JOIN cities c ON b.city_id = c.id
LEFT JOIN countries co ON b.country_id = co.id
WHERE rs.checked_date IS NOT NULL AND b.deleted_at IS NULL AND s.deleted_at IS NULL"""

ORACLE["extract_join"] = with_ctes(OPERATIONAL_CTES) + EXTRACT_SELECT
ORACLE["extract_sorted"] = ORACLE["extract_join"] + " ORDER BY building_id, maintenance_date"
ORACLE["extract_window"] = with_ctes(OPERATIONAL_CTES) + EXTRACT_SELECT.replace(
    """coalesce((SELECT max(r.created_at) FROM reports r WHERE r.building_id = b.id)
                >= rs.checked_date - INTERVAL 30 DAY, false)""",
    """EXISTS (SELECT 1 FROM reports r WHERE r.building_id = b.id
                       AND r.created_at >= rs.checked_date - INTERVAL 30 DAY
                       AND r.created_at <= rs.checked_date + INTERVAL 90 DAY)""")


# ------------------------------------------------------------------ coercion and vendor mapping
ORACLE["coerce_types"] = BASE + """
SELECT building_id, building_type, asset_type, maintenance_type,
       CASE WHEN l_linenumber = 5 THEN NULL ELSE maintenance_date END AS maintenance_date,
       CASE WHEN l_linenumber = 6 THEN true ELSE failure_reported END AS failure_reported,
       CASE WHEN l_linenumber = 4 THEN NULL ELSE downtime_days END AS downtime_days,
       maintenance_cost, technician_id, period_days, city, country, building_area,
       CASE WHEN l_linenumber = 7 THEN NULL ELSE building_floors END AS building_floors
FROM dirty"""

ORACLE["vendor_export"] = """
SELECT CAST(o.o_custkey AS BIGINT) AS building_id, lower(c.c_mktsegment) AS building_type, p.p_type AS asset_type,
       CASE l.l_linestatus WHEN 'O' THEN 'preventive' WHEN 'F' THEN 'corrective' ELSE 'emergency' END AS maintenance_type,
       l.l_shipdate AS maintenance_date, o.o_orderpriority = '1-URGENT' AS failure_reported,
       CAST(date_diff('day', CAST(o.o_orderdate AS DATE), CAST(l.l_shipdate AS DATE)) AS BIGINT) AS downtime_days,
       l.l_extendedprice * (1 - l.l_discount) AS maintenance_cost, CAST(l.l_suppkey AS BIGINT) AS technician_id,
       CAST(NULL AS BIGINT) AS period_days, CAST(NULL AS VARCHAR) AS city, CAST(NULL AS VARCHAR) AS country,
       1500.0 + c.c_acctbal AS building_area, CAST(1 + o.o_custkey % 25 AS BIGINT) AS building_floors
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey
JOIN part p ON l.l_partkey = p.p_partkey
WHERE l.l_shipdate >= TIMESTAMP '1998-01-01'"""


# ------------------------------------------------------------------ request contract, round trips
ORACLE["request_contract"] = BASE + """
, req AS (SELECT building_id, building_type, asset_type, CASE WHEN l_linenumber <> 7 THEN city END AS city,
                 building_area, building_floors, l_orderkey, l_linenumber FROM dirty)
SELECT *, concat_ws('|', CASE WHEN building_id IS NULL THEN 'building_id is required' END,
    CASE WHEN building_type IS NULL THEN 'building_type is required' END,
    CASE WHEN asset_type IS NULL THEN 'asset_type is required' END, CASE WHEN city IS NULL THEN 'city is required' END,
    CASE WHEN building_area IS NULL THEN 'building_area is required' END,
    CASE WHEN building_floors IS NULL THEN 'building_floors is required' END,
    CASE WHEN building_area <= 0 THEN 'building_area must be positive' END,
    CASE WHEN building_floors <= 0 THEN 'building_floors must be positive' END, 'country is required') AS violations
FROM req"""
for _name in ("csv_roundtrip", "json_roundtrip", "table_roundtrip", "json_shapes", "document_records"):
    ORACLE[_name] = BASE + f"SELECT {', '.join(REC_COLS)} FROM records"

ORACLE["document_dimensions"] = BASE + """
SELECT DISTINCT 'building' AS kind, CAST(building_id AS VARCHAR) AS member, concat_ws('|', building_type, city, country, building_floors) AS detail FROM records
UNION ALL SELECT DISTINCT 'technician', CAST(technician_id AS VARCHAR), '' FROM records
UNION ALL SELECT DISTINCT 'asset', asset_type, 'high' FROM records
UNION ALL SELECT 'system', 'exports', '500'"""

_REST = [c for c in REC_COLS if c not in ("building_id", "asset_type", "maintenance_date", "maintenance_type")]
ORACLE["landed_exact"] = BASE + f"""
SELECT {', '.join(REC_COLS)} FROM (SELECT *, row_number() OVER (
  PARTITION BY building_id, asset_type, maintenance_date, maintenance_type ORDER BY {', '.join(f'{c} NULLS FIRST' for c in _REST)}) AS rn
  FROM records WHERE NOT (coalesce(building_area <= 0, false) OR coalesce(building_floors <= 0, false) OR coalesce(maintenance_cost < 0, false)
    OR coalesce(downtime_days < 0, false) OR coalesce(NOT failure_reported AND downtime_days > 1, false) OR coalesce(period_days < 7 OR period_days > 365, false)))
WHERE rn = 1"""

_TIE = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice"
ORACLE["sample_rows"] = BASE + f"""
, r AS (SELECT building_id, asset_type, maintenance_date, {_TIE},
               md5(concat_ws('|', '42', l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, building_id)) AS h FROM records)
SELECT * EXCLUDE (h), 'head' AS kind FROM (SELECT * FROM r ORDER BY {_TIE}, building_id LIMIT 3)
UNION ALL SELECT * EXCLUDE (h), 'sample' AS kind FROM (SELECT * FROM r ORDER BY h, {_TIE}, building_id LIMIT 3)"""
