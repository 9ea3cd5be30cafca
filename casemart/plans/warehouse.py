"""Build, publish and open versions of the warehouse.

A version is a folder of parquet tables that is written once and never changed.
It becomes the current one when its name is appended to the list of published
versions, after everything else has been written: readers see the old version or
the new one, and a build that fails leaves only a folder nobody refers to.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date, datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from casemart.operators import dimensions
from casemart.operators.audit import row_counts
from casemart.operators.cleaning import clean
from casemart.operators.fact import flagged_fact
from casemart.operators.integrity import check_unique, row_rules, rule_counts
from casemart.operators.marts import register_views
from casemart.operators.rollup import mart_sums
from casemart.operators.star import Star
from casemart.plans.views import define, definitions
from casemart.schema import TABLES
from casemart.session import together


# The order of a month's rows: the keys that reports group by, few values first.
FACT_ORDER = ["status_key", "department_key", "location_key", "request_type_key"]

# What the tables of a version are like; versions from before the first number have none.
WITH_SUMS, WITH_VIEWS = 1, 2
LAYOUT = WITH_VIEWS


@dataclass(frozen=True)
class Warehouse:
    """One version of the warehouse."""

    spark: SparkSession
    root: str
    version: str
    layout: int = LAYOUT

    @property
    def folder(self) -> str:
        return f"{self.root}/versions/{self.version}"

    def path(self, table: str) -> str:
        return f"{self.folder}/{table}"

    def table(self, name: str) -> DataFrame:
        """A stored table, read with its fixed schema."""
        return self.spark.read.schema(TABLES[name]).parquet(self.path(name))

    def staging(self) -> DataFrame:
        return self.table("staging")

    def counts(self, table: str) -> dict[str, int]:
        """What was counted in the pass that wrote a table: one row."""
        return self.spark.read.parquet(self.path(f"counts/{table}")).first().asDict()

    def star(self) -> Star:
        return Star(
            fact=self.table("fact_service_requests"),
            dates=self.table("dim_date"),
            locations=self.table("dim_location"),
            request_types=self.table("dim_request_type"),
            departments=self.table("dim_department"),
            statuses=self.table("dim_status"),
            sums=self.table("mart_sums") if self.layout >= WITH_SUMS else None,
        )


def new_version(spark: SparkSession, root: str) -> Warehouse:
    """A version that has no tables yet; names sort by time."""
    moment = datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%S%f")
    return Warehouse(spark, root.rstrip("/"), f"{moment}-{uuid.uuid4().hex[:8]}")


def staging_counts(staging: DataFrame) -> list[Column]:
    """What the audit and the rules count in staging."""
    return [*row_counts(staging.schema), *rule_counts(row_rules("staging", staging.columns))]


def one_row(spark: SparkSession, counts: dict[str, int]) -> DataFrame:
    """Counts by name, as a table of one row."""
    return spark.createDataFrame([tuple(counts.values())], ", ".join(f"`{name}` BIGINT" for name in counts))


def write_counted(frame: DataFrame, path: str, counts: list[Column], *folders: str) -> dict[str, int]:
    """Write a table, and count in the same pass; returns the counts by name.

    The counts are taken where the rows are written, in the job's last stage: there Spark adds up what the
    successful attempt of each task counted, once.
    """
    seen = Observation()
    frame.observe(seen, *counts).write.mode("overwrite").parquet(path, partitionBy=list(folders) or None)
    return seen.get


def _written(warehouse: Warehouse, frame: DataFrame, table: str, counts: list[Column], *folders: str) -> dict[str, int]:
    """Write a table of the version, and what was counted in that pass."""
    found = write_counted(frame, warehouse.path(table), counts, *folders)
    one_row(warehouse.spark, found).write.mode("overwrite").parquet(warehouse.path(f"counts/{table}"))
    return found


def stage(warehouse: Warehouse, tickets: DataFrame, arrival: Sequence[str]) -> dict[str, int]:
    """Clean the tickets into the staging table; returns what `staging_counts` counts in the rows written."""
    staging = (
        clean(tickets, arrival)
        .drop(*arrival)
        .withColumns({"raw_id": F.monotonically_increasing_id(), "ingested_at": F.current_timestamp()})
    )
    return _written(warehouse, staging, "staging", staging_counts(staging))


def build_dimensions(warehouse: Warehouse) -> DataFrame:
    """Write the five dimensions, numbered; return the checks of their keys.

    Each reads its own columns of staging and no others, so the five scans
    together read every column once. The sorted rows that the numbers come from
    stay in the version's folder. A dimension with a repeated key would multiply
    the rows joined to it; no fact is built on one.
    """
    staging = warehouse.staging()

    def write(name: str, build: Callable[[], DataFrame]) -> Callable[[], None]:
        def job() -> None:
            rows = build()
            if name in dimensions.KEYS:
                key, order = dimensions.KEYS[name]
                rows = dimensions.number_rows(rows, order, key, warehouse.path(f"sorted/{name}"))
            rows.write.mode("overwrite").parquet(warehouse.path(name))

        return job

    together(
        warehouse.spark,
        write("dim_date", lambda: dimensions.dim_date(dimensions.date_bounds(staging))),
        write("dim_location", lambda: dimensions.dim_location(staging)),
        write("dim_request_type", lambda: dimensions.dim_request_type(staging)),
        write("dim_department", lambda: dimensions.dim_department(staging)),
        write("dim_status", lambda: dimensions.dim_status(staging)),
    )
    tables = {name: warehouse.table(name) for name in TABLES if name.startswith("dim_")}
    # One row per rule.
    found = check_unique(tables).collect()
    for row in found:
        if row["violations"] > 0:
            raise ValueError(f"{row['rule']} has {row['violations']} repeated keys")
    return warehouse.spark.createDataFrame(found, "rule STRING, violations BIGINT")


def write_fact(warehouse: Warehouse, how: str = "inner") -> dict[str, int]:
    """Write the fact, one folder per month of creation of open and of closed tickets, and the sums that the marts
    read; returns what the rules of `row_rules` count in the rows written.

    The rebalance hint gathers a month's rows into files of the advisory size,
    and adaptive execution splits a month that is far larger than that. Writing
    by month sorts by month anyway; sorting on by the keys turns them into runs,
    which parquet stores in a fraction of the space.
    """
    star_dimensions = [
        warehouse.table(name)
        for name in ["dim_location", "dim_request_type", "dim_department", "dim_status"]
    ]
    fact = flagged_fact(warehouse.staging(), *star_dimensions, how=how)
    month = F.floor(F.col("created_date_key") / 100).cast("int")
    laid_out = (
        fact.withColumn("created_month", month)
        .hint("rebalance", F.col("is_open"), F.col("created_month"))
        .sortWithinPartitions("is_open", "created_month", *FACT_ORDER)
        .withColumns({"fact_id": F.monotonically_increasing_id(), "created_at": F.current_timestamp()})
    )
    rules = rule_counts(row_rules("fact_service_requests", laid_out.columns))
    counts = _written(warehouse, laid_out, "fact_service_requests", rules, "is_open", "created_month")
    write_sums(warehouse)
    return counts


def write_sums(warehouse: Warehouse) -> None:
    """Write the sums of the fact at the grains of the marts, one folder per grain."""
    sums = mart_sums(warehouse.table("fact_service_requests")).hint("rebalance", F.col("grain"))
    sums.write.mode("overwrite").partitionBy("grain").parquet(warehouse.path("mart_sums"))


def publish(warehouse: Warehouse) -> None:
    """Make the version the current one. Its marts are kept with it, as SQL text."""
    definitions(warehouse.spark).coalesce(1).write.mode("overwrite").json(warehouse.path("views"))
    (
        warehouse.spark.range(1)
        .select(
            F.lit(warehouse.version).alias("version"),
            F.current_timestamp().alias("published_at"),
            F.lit(warehouse.layout).alias("layout"),
        )
        .write.mode("append")
        .json(f"{warehouse.root}/published")
    )


def build_warehouse(
    spark: SparkSession, tickets: DataFrame, arrival: Sequence[str], root: str, how: str = "inner"
) -> Warehouse:
    """Staging, dimensions and fact from raw tickets, published at the end."""
    warehouse = new_version(spark, root)
    stage(warehouse, tickets, arrival)
    build_dimensions(warehouse)
    write_fact(warehouse, how)
    publish(warehouse)
    return warehouse


def open_warehouse(spark: SparkSession, root: str) -> Warehouse:
    """The current version: the one that was published last."""
    published = spark.read.schema("version STRING, published_at TIMESTAMP, layout INT").json(f"{root}/published")
    named = F.struct("version", F.coalesce("layout", F.lit(0)).alias("layout"))
    current = published.agg(F.max_by(named, F.struct("published_at", "version"))).first()[0]
    if current is None:
        raise ValueError(f"no version is published in {root}")
    return Warehouse(spark, root.rstrip("/"), current["version"], current["layout"])


def open_views(spark: SparkSession, root: str, as_of: date | str | None = None) -> Warehouse:
    """The current version, with its tables and the six marts as views for spark.sql.

    The marts are those whose text was kept when the version was published; a version from before texts were kept gets
    today's.
    """
    warehouse = open_warehouse(spark, root)
    star = warehouse.star()
    if warehouse.layout < WITH_VIEWS:
        register_views(star, as_of)
        return warehouse
    kept = spark.read.schema("name STRING, text STRING").json(warehouse.path("views"))
    # Six rows.
    texts = {row["name"]: row["text"] for row in kept.collect()}
    define(spark, {**star.tables(), "mart_sums": star.sums}, texts, as_of)
    return warehouse
