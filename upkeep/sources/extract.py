"""Operational-database extract (J1-J10) re-expressed as DataFrame joins.

The operational schema: buildings, building_types, cities, countries,
building_service_technician, services, recurring_services, reports,
building_resident, resident_invoice.  Each table is read on its own
(JDBC with a partition column, or any DataFrame) and joined in Spark:

* dimensions (types, cities, countries) are equi left joins; Spark's
  planner broadcasts them when its size estimate allows;
* the WHERE on ``checked_date`` makes the service joins inner, written so;
* the "recent report" flag (a report on the building created no earlier
  than 30 days before the check) only needs the building's latest report
  date: a per-building max aggregate and an equi join, not a range join
  that multiplies rows;
* the correlated "first resident of the building" subquery is decorrelated
  into a per-building min aggregate followed by equi joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from upkeep.operators.scan import ordered_scan, segment
from upkeep.session import materialize

OPERATIONAL_TABLES = ["buildings", "building_types", "cities", "countries", "building_service_technician",
                      "services", "recurring_services", "reports", "building_resident", "resident_invoice"]
REPORT_LOOKBACK_DAYS = 30


def read_operational_jdbc(spark: SparkSession, url: str, properties: dict | None = None,
                          partitions: int = 64, bounds: dict | None = None) -> dict:
    """One JDBC read per table; large tables split on a numeric column."""
    properties = properties or {}
    split_on = {"buildings": "id", "recurring_services": "building_id", "reports": "building_id",
                "building_service_technician": "building_id", "building_resident": "building_id",
                "resident_invoice": "resident_id"}
    tables = {}
    for t in OPERATIONAL_TABLES:
        if t in split_on and bounds and t in bounds:
            lo, hi = bounds[t]
            tables[t] = spark.read.jdbc(url, t, column=split_on[t], lowerBound=lo, upperBound=hi,
                                        numPartitions=partitions, properties=properties)
        else:
            tables[t] = spark.read.jdbc(url, t, properties=properties)
    return tables


def extract_records(t: dict, lookback_days: int = REPORT_LOOKBACK_DAYS,
                    window_days: int | None = None) -> DataFrame:
    """Canonical maintenance records from the operational tables.

    ``window_days`` adds an upper bound to the report window (reports up to
    that many days after the check); the default keeps the open bound.
    """
    b = t["buildings"].filter(F.col("deleted_at").isNull()).select(
        F.col("id").alias("building_id"), F.col("type").alias("_type"), F.col("area").alias("building_area"),
        F.col("number_of_floors").alias("building_floors"), F.col("city_id").alias("_city"),
        F.col("country_id").alias("_country"))
    bt = t["building_types"].select(F.col("code").alias("_type"), F.col("name").alias("building_type"))
    bst = t["building_service_technician"].select(
        "building_id", F.col("service_id").alias("_service"), F.col("user_id").alias("technician_id"),
        "period_days")
    svc = t["services"].filter(F.col("deleted_at").isNull()).select(
        F.col("id").alias("_service"), F.col("title").alias("asset_type"))
    rs = t["recurring_services"].filter(F.col("checked_date").isNotNull()).select(
        F.col("service_id").alias("_service"), "building_id", F.col("checked_date").alias("maintenance_date"))
    cities = t["cities"].select(F.col("id").alias("_city"), F.col("name").alias("city"))
    countries = t["countries"].select(F.col("id").alias("_country"), F.col("name").alias("country"))

    # The building's first resident and that resident's smallest invoice (one, so no record multiplies)
    first_res = t["building_resident"].groupBy("building_id").agg(F.min("resident_id").alias("_resident"))
    inv = t["resident_invoice"].groupBy(F.col("resident_id").alias("_resident")).agg(F.min("value").alias("_value"))

    # what belongs to a building is joined building by building, so that the checks are shuffled without it
    owners = (b.join(bt, "_type", "left")
              .join(first_res, "building_id", "left")
              .join(inv, "_resident", "left")
              .join(cities, "_city", "left")
              .join(countries, "_country", "left"))
    checks = rs.join(bst.join(svc, "_service"), ["_service", "building_id"])

    since = F.col("maintenance_date") - F.make_interval(days=F.lit(lookback_days))
    if window_days is None:
        # Exists a report at or after (check - 30 days)  <=>  latest report >= check - 30 days
        latest = t["reports"].groupBy("building_id").agg(F.max("created_at").alias("_latest"))
        recs = checks.join(owners.join(latest, "building_id", "left"), "building_id").withColumn(
            "failure_reported", F.coalesce(F.col("_latest") >= since, F.lit(False)))
    else:
        # each part is stored as it is made, so that its shuffled files need not stay until the last join
        flags = materialize(reports_in_window(rs.select("building_id", "maintenance_date"), t["reports"], lookback_days, window_days))
        checks = materialize(checks.drop("_service"))
        recs = (checks.join(flags, ["building_id", "maintenance_date"], "left").join(materialize(owners), "building_id")
                .withColumn("failure_reported", F.coalesce(F.col("_reported"), F.lit(False))))

    return recs.select(
        "building_id", "building_type", "asset_type", F.lit("preventive").alias("maintenance_type"),
        "maintenance_date", "failure_reported", F.lit(0).cast("long").alias("downtime_days"),
        F.coalesce(F.col("_value").cast("double"), F.lit(0.0)).alias("maintenance_cost"),
        F.col("technician_id").cast("long").alias("technician_id"),
        F.col("period_days").cast("long").alias("period_days"), "city", "country",
        F.col("building_area").cast("double").alias("building_area"),
        F.col("building_floors").cast("long").alias("building_floors"))


def reports_in_window(checks: DataFrame, reports: DataFrame, lookback_days: int, window_days: int,
                      max_rows: int | None = None) -> DataFrame:
    """building_id, maintenance_date, _reported of the distinct checks: a report from ``lookback_days`` before to ``window_days`` after, both included.

    No range join: each check puts a probe at either end of its window among
    the building's reports, one ordered scan counts the reports up to each
    place, and the window holds a report if the counts differ.  A hot building is cut into
    segments of time; checks and reports are combined by day and time first.
    """
    day = F.col("maintenance_date")
    asked = checks.where("building_id IS NOT NULL AND maintenance_date IS NOT NULL").distinct()
    ends = F.array(F.struct((day - F.make_interval(days=F.lit(lookback_days))).alias("at"), F.lit(0).alias("kind")),
                   F.struct((day + F.make_interval(days=F.lit(window_days))).alias("at"), F.lit(2).alias("kind")))
    probes = asked.withColumn("_e", F.explode(ends)).select("building_id", "maintenance_date", "_e.at", "_e.kind", F.lit(0).cast("long").alias("n"))
    held = (reports.where("building_id IS NOT NULL AND created_at IS NOT NULL").groupBy("building_id", F.col("created_at").alias("at"))
            .agg(F.count(F.lit(1)).alias("n")).withColumn("kind", F.lit(1)))
    # at the same time a window's start comes before a report and its end after it
    events = materialize(probes.unionByName(held, allowMissingColumns=True).withColumn("x", F.unix_micros(F.col("at").cast("timestamp"))).drop("at"))
    seg = segment(events, ["building_id"], "x", **({"max_rows": max_rows} if max_rows else {}))
    run = ordered_scan(seg, order=[F.col("x"), F.col("kind")], sums={"so_far": F.col("n")}).where("kind <> 1")
    before, until = (F.max(F.when(F.col("kind") == k, F.col("so_far"))) for k in (0, 2))
    return run.groupBy("building_id", "maintenance_date").agg((until > before).alias("_reported"))


def sorted_extract(df: DataFrame) -> DataFrame:
    """The extract ordered by building and date (range-partitioned sort)."""
    return df.orderBy("building_id", "maintenance_date")


# ----------------------------------------------------------------------------
# Operational tables derived from the benchmark tables (for tests and queries)
# ----------------------------------------------------------------------------
def operational_from_tables(spark: SparkSession, sf_dir: str) -> dict:
    rd = lambda n: spark.read.parquet(f"{sf_dir}/{n}.parquet")
    cust, nation, region = rd("customer"), rd("nation"), rd("region")
    part, orders, li = rd("part"), rd("orders"), rd("lineitem")
    deleted = F.to_timestamp(F.lit("2000-01-01"))
    # stored, as two of the tables come from it and each is read more than once
    lo = materialize(li.join(orders, li.l_orderkey == orders.o_orderkey).select("o_custkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate"))
    return {
        "buildings": cust.join(F.broadcast(nation), cust.c_nationkey == nation.n_nationkey).select(
            F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("type"),
            (F.lit(1500.0) + F.col("c_acctbal")).alias("area"),
            (F.lit(1) + F.col("c_custkey") % 25).cast("long").alias("number_of_floors"),
            F.col("c_nationkey").alias("city_id"), F.col("n_regionkey").alias("country_id"),
            F.when(F.col("c_custkey") % 50 == 0, deleted).alias("deleted_at")),
        "building_types": cust.select(F.col("c_mktsegment").alias("code")).distinct()
            .withColumn("name", F.lower("code")),
        "cities": nation.select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name")),
        "countries": region.select(F.col("r_regionkey").alias("id"), F.col("r_name").alias("name")),
        "services": part.select(F.col("p_partkey").alias("id"), F.col("p_type").alias("title"),
                                F.when(F.col("p_size") > 45, deleted).alias("deleted_at")),
        "building_service_technician": lo.groupBy(F.col("o_custkey").alias("building_id"),
                                                  F.col("l_partkey").alias("service_id"))
            .agg(F.min("l_suppkey").alias("user_id"))
            .withColumn("period_days", (F.lit(30) * (F.lit(1) + F.col("service_id") % 4)).cast("long")),
        "recurring_services": lo.select(
            F.col("l_partkey").alias("service_id"), F.col("o_custkey").alias("building_id"),
            F.when(F.col("l_linenumber") != 7, F.col("l_shipdate")).alias("checked_date")),
        "reports": orders.filter(F.col("o_orderstatus") == "F").select(
            F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("building_id"),
            F.col("o_orderdate").alias("created_at")),
        "building_resident": orders.select(F.col("o_orderkey").alias("resident_id"),
                                           F.col("o_custkey").alias("building_id")),
        # every third resident has two invoices
        "resident_invoice": orders.select(
            F.col("o_orderkey").alias("resident_id"),
            F.explode(F.when(F.col("o_orderkey") % 3 == 0, F.array(F.col("o_totalprice") / 100.0, F.col("o_totalprice") / 50.0))
                      .otherwise(F.array(F.col("o_totalprice") / 100.0))).alias("value")),
    }
