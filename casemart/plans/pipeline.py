"""The batch pipeline: raw tickets to published marts."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from casemart.operators.audit import audit, row_log
from casemart.operators.drilldown import headlines
from casemart.operators.integrity import (
    check_foreign_keys,
    check_lost_tickets,
    check_rows,
    check_unique,
    row_rules,
    rule_log,
)
from casemart.operators.marts import VIEWS, all_marts, register_views
from casemart.plans.warehouse import (
    Warehouse,
    build_dimensions,
    new_version,
    one_row,
    publish,
    stage,
    write_fact,
)
from casemart.session import BYTES_PER_PARTITION, MOST_PARTITIONS, shuffles_released, sized_shuffles, together
from casemart.sinks.exports import write_marts, write_payload
from casemart.sources.tickets import ARRIVAL, read_tickets


@dataclass(frozen=True)
class PipelineRun:
    """What a run produced; every frame reads tables the run has written."""

    warehouse: Warehouse
    staged_rows: int
    raw_audit: DataFrame
    audit_log: DataFrame
    integrity: DataFrame
    marts: dict[str, DataFrame]
    headlines: DataFrame


def run_pipeline(
    spark: SparkSession,
    source: str | DataFrame,
    root: str,
    as_of: date | str | None = None,
    export: bool = True,
    fmt: str = "parquet",
    arrival: Sequence[str] = tuple(ARRIVAL),
    how: str = "inner",
    months: int | None = None,
    bytes_per_partition: int = BYTES_PER_PARTITION,
    most_partitions: int = MOST_PARTITIONS,
) -> PipelineRun:
    """Clean, stage, audit, build the star, compute the marts, publish, export.

    `source` is a path read with `fmt`, or raw tickets with `arrival` columns.
    Shuffles start with a partition per `bytes_per_partition` of the tables that
    are read, and `most_partitions` at most. `months` limits the exported trends
    to that many of the earliest months; all are exported by default.

    The raw tickets are audited as they arrived; staging only for what cleaning
    does not settle, in the pass that writes it. Audits report and do not stop the run. The new version is
    published when its tables, checks and marts are written, and exported after
    that: an export that fails leaves it published. Running again replaces the
    current version and adds to nothing.
    """
    if isinstance(source, str):
        source, arrival = read_tickets(spark, source, fmt), ARRIVAL
    # Every table of a run is written when its query ends, so no later query needs a shuffle.
    with sized_shuffles(source, bytes_per_partition, most_partitions), shuffles_released(spark):
        return _run(spark, source, root, as_of, export, arrival, how, months)


def _run(
    spark: SparkSession,
    source: DataFrame,
    root: str,
    as_of: date | str | None,
    export: bool,
    arrival: Sequence[str],
    how: str,
    months: int | None,
) -> PipelineRun:
    warehouse = new_version(spark, root)

    def save(frame: DataFrame, name: str) -> DataFrame:
        frame.write.mode("overwrite").parquet(warehouse.path(name))
        return spark.read.schema(frame.schema).parquet(warehouse.path(name))

    staged, raw_audit = together(
        spark,
        lambda: stage(warehouse, source, arrival),
        lambda: save(audit(source), "raw_audit"),
    )
    audit_log = save(row_log(one_row(spark, staged)), "audit_log")
    dimension_keys = build_dimensions(warehouse)
    stored = write_fact(warehouse, how)
    star = warehouse.star()

    computed = all_marts(star, as_of)
    saved = together(
        spark,
        lambda: save(_integrity(warehouse, dimension_keys, staged, stored), "integrity"),
        *[lambda name=name: save(computed[name], f"marts/{name}") for name in VIEWS],
    )
    integrity, marts = saved[0], dict(zip(VIEWS, saved[1:], strict=True))
    publish(warehouse)
    register_views(star, as_of)
    if export:
        write_marts(marts, warehouse.path("export"))
        trends = VIEWS[2]
        shown = marts[trends] if months is None else marts[trends].orderBy("year", "month").limit(months)
        write_payload({**marts, trends: shown}, warehouse.path("export/kpi_payload"))
    return PipelineRun(
        warehouse, staged["_rows"], raw_audit, audit_log, integrity, marts, headlines(marts[VIEWS[0]])
    )


def _integrity(
    warehouse: Warehouse, dimension_keys: DataFrame, staged: dict[str, int], stored: dict[str, int]
) -> DataFrame:
    """All checks. The keys of the dimensions were checked when they were built, and the rows of staging and of
    the fact were when they were written: neither is read again for what a row breaks by itself."""
    spark, star = warehouse.spark, warehouse.star()
    tables = star.tables()
    fact = "fact_service_requests"
    checks = [
        check_unique({fact: star.fact}),
        check_rows({name: table for name, table in tables.items() if name != fact}),
        rule_log(one_row(spark, staged), row_rules("staging", warehouse.staging().columns)),
        rule_log(one_row(spark, stored), row_rules(fact, star.fact.columns)),
        check_foreign_keys(star),
        check_lost_tickets(warehouse.staging(), star),
    ]
    return reduce(DataFrame.unionByName, checks, dimension_keys)
