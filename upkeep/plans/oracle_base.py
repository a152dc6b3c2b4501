"""SQL text shared by the DuckDB oracles: the record adapter as CTEs.

The oracles are reference implementations written as plain ANSI SQL over the
same Parquet tables; they are only used to check the Spark plans.
"""

RECORDS_CTE = """
records AS (
  SELECT
    CAST(o.o_custkey AS BIGINT) AS building_id,
    lower(c.c_mktsegment) AS building_type,
    p.p_type AS asset_type,
    CASE l.l_returnflag WHEN 'N' THEN 'preventive' WHEN 'R' THEN 'corrective'
                        WHEN 'A' THEN 'emergency' END AS maintenance_type,
    l.l_shipdate AS maintenance_date,
    (l.l_returnflag = 'R') AS failure_reported,
    CAST(CASE WHEN l.l_returnflag = 'R' THEN l.l_linenumber ELSE 0 END AS BIGINT) AS downtime_days,
    CAST(l.l_extendedprice / 100.0 AS DOUBLE) AS maintenance_cost,
    CAST(l.l_suppkey AS BIGINT) AS technician_id,
    CAST(CASE WHEN l.l_returnflag = 'N' THEN 30 * (1 + l.l_linenumber % 4) END AS BIGINT) AS period_days,
    n.n_name AS city,
    r.r_name AS country,
    CAST(1500.0 + c.c_acctbal AS DOUBLE) AS building_area,
    CAST(1 + o.o_custkey % 25 AS BIGINT) AS building_floors,
    l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_extendedprice
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
  JOIN part p ON l.l_partkey = p.p_partkey
)"""

DIRTY_CTE = """
dirty AS (
  SELECT building_id, building_type,
    CASE WHEN l_orderkey % 211 = 0 THEN NULL WHEN l_partkey % 7 = 0 THEN 'elevator' ELSE asset_type END AS asset_type,
    maintenance_type,
    CASE WHEN l_orderkey % 307 = 0 THEN maintenance_date + INTERVAL 7300 DAY
         WHEN l_orderkey % 311 = 0 THEN maintenance_date - INTERVAL 11000 DAY ELSE maintenance_date END AS maintenance_date,
    failure_reported,
    CASE WHEN l_orderkey % 101 = 0 OR l_suppkey % 19 = 0 THEN NULL WHEN l_suppkey % 29 = 0 THEN -1
         WHEN l_suppkey % 31 = 0 AND NOT failure_reported THEN 5 ELSE downtime_days END AS downtime_days,
    CASE WHEN l_orderkey % 101 = 0 OR l_partkey % 17 = 0 OR asset_type LIKE 'PROMO%TIN' THEN NULL
         WHEN l_partkey % 23 = 0 THEN -maintenance_cost ELSE maintenance_cost END AS maintenance_cost,
    CASE WHEN l_orderkey % 101 <> 0 AND l_suppkey % 13 <> 0 THEN technician_id END AS technician_id,
    CASE WHEN l_orderkey % 101 = 0 OR l_suppkey % 11 = 0 THEN NULL WHEN l_suppkey % 37 = 0 THEN 400 ELSE period_days END AS period_days,
    CASE WHEN l_orderkey % 101 <> 0 THEN city END AS city,
    CASE WHEN l_orderkey % 101 <> 0 THEN country END AS country,
    CASE WHEN building_id % 97 = 0 THEN 0.0 ELSE building_area END AS building_area,
    CASE WHEN building_id % 89 = 0 THEN 0 ELSE building_floors END AS building_floors,
    l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice
  FROM records
)"""

TIE_SQL = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice"


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n"
