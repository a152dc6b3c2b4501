"""Bridge from the benchmark star schema to canonical maintenance records.

A line item is one maintenance event: the ordering customer is the building,
the part type is the asset, the supplier is the technician, the return flag
decides preventive / corrective / emergency.  The mapping is a plain
projection over inner equi-joins, so Catalyst prunes every unused column at
the Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from upkeep.schema import RECORD_COLUMNS

# Source columns that give a total order to records with equal dates.
ADAPTER_TIE = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def records_from_tables(spark: SparkSession, sf_dir: str, dirty: bool = False,
                        keep_tie: bool = True) -> DataFrame:
    """Canonical records (plus tie-break columns) from the driver tables.

    ``dirty`` injects deterministic defects so that every cleaning rule and
    fill has something to do: nulls in essentials and measures, rows with
    many nulls, values that break each business rule, dates too old and in
    the future, asset types without any cost, and critical asset types.
    """
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice",
        "l_returnflag", "l_shipdate")
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    cust = read_table(spark, sf_dir, "customer").select(
        "c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_type")
    # nation (25 rows) and region (5 rows) are fixed-size dimensions.
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")

    # Customers meet the orders, not the line items, and the names of nations and regions come
    # last: the longest table is shuffled twice at most, and only with its own columns and the part type.
    owners = (orders.join(cust, orders.o_custkey == cust.c_custkey)
              .select("o_orderkey", "o_custkey", "c_nationkey", "c_acctbal", "c_mktsegment"))
    places = nation.join(region, nation.n_regionkey == region.r_regionkey).select("n_nationkey", "n_name", "r_name")
    joined = (li
              .join(part, li.l_partkey == part.p_partkey)
              .join(owners, li.l_orderkey == owners.o_orderkey)
              .join(F.broadcast(places), F.col("c_nationkey") == places.n_nationkey))

    flag = F.col("l_returnflag")
    cost = F.col("l_extendedprice") / F.lit(100.0)
    area = F.lit(1500.0) + F.col("c_acctbal")
    technician = F.col("l_suppkey")
    asset, date, city, country = F.col("p_type"), F.col("l_shipdate"), F.col("n_name"), F.col("r_name")
    downtime = F.when(flag == "R", F.col("l_linenumber")).otherwise(F.lit(0))
    period = F.when(flag == "N", F.lit(30) * (F.lit(1) + F.col("l_linenumber") % 4))
    floors = F.lit(1) + F.col("o_custkey") % 25
    if dirty:
        order, supplier, item = F.col("l_orderkey"), F.col("l_suppkey"), F.col("l_partkey")
        whole = order % 101 != 0    # the others miss six values
        cost = F.when(item % 23 == 0, -cost).otherwise(cost)
        cost = F.when(whole & (item % 17 != 0) & ~F.col("p_type").like("PROMO%TIN"), cost)
        area = F.when(F.col("o_custkey") % 97 == 0, F.lit(0.0)).otherwise(area)
        floors = F.when(F.col("o_custkey") % 89 == 0, F.lit(0)).otherwise(floors)
        technician = F.when(whole & (supplier % 13 != 0), technician)
        downtime = (F.when(supplier % 29 == 0, F.lit(-1)).when((supplier % 31 == 0) & (flag != "R"), F.lit(5))
                    .otherwise(downtime))
        downtime = F.when(whole & (supplier % 19 != 0), downtime)
        period = F.when(supplier % 37 == 0, F.lit(400)).otherwise(period)
        period = F.when(whole & (supplier % 11 != 0), period)
        asset = F.when(order % 211 != 0, F.when(item % 7 == 0, F.lit("elevator")).otherwise(asset))
        date = (F.when(order % 307 == 0, date + F.make_interval(days=F.lit(7300)))
                .when(order % 311 == 0, date - F.make_interval(days=F.lit(11000))).otherwise(date))
        city, country = F.when(whole, city), F.when(whole, country)

    cols = [
        F.col("o_custkey").cast("long").alias("building_id"),
        F.lower(F.col("c_mktsegment")).alias("building_type"),
        asset.alias("asset_type"),
        (F.when(flag == "N", "preventive").when(flag == "R", "corrective")
         .when(flag == "A", "emergency")).alias("maintenance_type"),
        date.alias("maintenance_date"),
        (flag == "R").alias("failure_reported"),
        downtime.cast("long").alias("downtime_days"),
        cost.cast("double").alias("maintenance_cost"),
        technician.cast("long").alias("technician_id"),
        period.cast("long").alias("period_days"),
        city.alias("city"),
        country.alias("country"),
        area.cast("double").alias("building_area"),
        floors.cast("long").alias("building_floors"),
    ]
    out = joined.select(*cols, *ADAPTER_TIE)
    return out if keep_tie else out.select(*RECORD_COLUMNS)
