"""Derive raw tickets from order tables: one ticket row per order line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casemart.schema import RAW_COLUMNS

# A total order of the raw rows of one ticket.
ARRIVAL = ["arrival_date", "arrival_part", "arrival_supplier"]

# Fixed values of the derivation: target hours by order priority, and the map
# position around which tickets are spread.
TARGET_HOURS = {
    "1-URGENT": 12,
    "2-HIGH": 24,
    "3-MEDIUM": 48,
    "4-NOT SPECIFIED": 72,
    "5-LOW": 168,
}
LATITUDE = "32.6"
LONGITUDE = "-85.48"

HIDDEN_DISTRICT = 7
HIDDEN_ZIP = [7, 9]


def derive_tickets(spark: SparkSession, folder: str) -> DataFrame:
    """Raw tickets with ARRIVAL columns, from the parquet tables in `folder`.

    Orders meet their customers first, because that shuffles the narrow order
    rows and not the order lines. No join is hinted: Spark broadcasts a table
    only when its files are under the broadcast threshold, and splits skewed
    sort-merge joins otherwise.
    """

    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{folder}/{name}.parquet")

    places = (
        table("nation")
        .join(table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("n_nationkey", "n_name", "r_name")
    )
    customers = (
        table("customer")
        .join(places, F.col("c_nationkey") == F.col("n_nationkey"))
        .select("c_custkey", "c_mktsegment", "n_nationkey", "n_name", "r_name")
    )
    orders = (
        table("orders")
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .drop("o_custkey", "c_custkey", "o_totalprice")
    )
    parts = table("part").select("p_partkey", "p_type", "p_brand")
    lines = (
        table("lineitem")
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    )
    return lines.select(*_ticket_columns()).select(*RAW_COLUMNS, *ARRIVAL)


def _ticket_columns():
    line = F.col("l_linenumber")
    finished = F.col("o_orderstatus") == "F"
    returned = F.col("l_returnflag")
    nation = F.col("n_nationkey")
    nation_code = F.lpad(nation.cast("string"), 2, "0")
    created = F.timestamp_add("HOUR", line * 3, F.col("o_orderdate"))

    seconds = F.floor("l_extendedprice") * 3
    backwards = (line == 7) & (returned == "R")
    closed = F.timestamp_add("SECOND", F.when(backwards, -seconds).otherwise(seconds), created)

    target = F.coalesce(
        *[
            F.when(F.col("o_orderpriority") == priority, F.lit(hours))
            for priority, hours in TARGET_HOURS.items()
        ]
    )
    status = (
        F.when(finished & (returned == "A"), "Closed - Duplicate")
        .when(finished, "Closed - Resolved")
        .when(F.col("o_orderstatus") == "P", "In Progress")
        .when(F.col("o_orderstatus") == "O", "Assigned")
    )
    east = (F.col("l_partkey") % 200 - 100).cast("decimal(10,0)") * F.lit("0.0001").cast(
        "decimal(5,4)"
    )
    north = (F.col("l_suppkey") % 10 - 5).cast("decimal(10,0)") * F.lit("0.001").cast(
        "decimal(4,3)"
    )
    return [
        F.concat(
            F.lit("SR-"), F.col("l_orderkey").cast("string"), F.lit("-"), line.cast("string")
        ).alias("ticket_number"),
        created.alias("created_date"),
        F.when(finished, closed).alias("closed_date"),
        target.cast("decimal(10,2)").alias("target_sla_hours"),
        F.when(line == 3, F.concat(F.lit("  "), F.col("r_name"), F.lit(" ")))
        .otherwise(F.col("r_name"))
        .alias("department_name"),
        F.col("c_mktsegment").alias("division_name"),
        F.col("p_type").alias("request_category"),
        F.col("p_brand").alias("request_type"),
        F.col("o_orderpriority").alias("priority_level"),
        status.alias("status"),
        F.when(nation != HIDDEN_DISTRICT, F.concat(F.lit("DIST-"), nation_code)).alias(
            "district_code"
        ),
        F.when(nation != HIDDEN_DISTRICT, F.col("n_name")).alias("neighborhood"),
        F.when(~nation.isin(HIDDEN_ZIP), F.concat(F.lit("368"), nation_code)).alias("zip_code"),
        (F.lit(LATITUDE).cast("decimal(10,6)") + east).cast("decimal(10,6)").alias("latitude"),
        (F.lit(LONGITUDE).cast("decimal(10,6)") + north).cast("decimal(10,6)").alias("longitude"),
        F.when(finished, 1 + F.col("l_quantity").cast("int") % 5).alias("satisfaction_rating"),
        F.when(line != 5, F.col("l_tax") >= 0.07).alias("is_repeat"),
        F.when(line % 2 == 1, "Web").otherwise("Phone").alias("channel"),
        F.col("l_shipdate").alias("arrival_date"),
        F.col("l_partkey").alias("arrival_part"),
        F.col("l_suppkey").alias("arrival_supplier"),
    ]
