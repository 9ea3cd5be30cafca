"""Run the pipeline from the command line and print what it reports.

    spark-submit ... -m casemart SOURCE WAREHOUSE [--format csv] [--as-of 2025-01-31]
"""

from __future__ import annotations

import argparse

from casemart.plans.pipeline import PipelineRun, run_pipeline
from casemart.session import session


def report(run: PipelineRun) -> str:
    """The audits and the headline figures; a fixed, small number of rows."""
    checks = [
        f"[{row['status']}] {where}, {row['check_name']}: {row['details']}"
        for where, log in [("raw", run.raw_audit), ("staged", run.audit_log)]
        for row in log.collect()
    ]
    broken = [
        f"[FAILED] {row['rule']}: {row['violations']} violations"
        for row in run.integrity.filter("violations > 0").collect()
    ]
    figures = [
        f"{row['label']}: {row['figure']}" for row in run.headlines.orderBy("position").collect()
    ]
    return "\n".join([f"{run.staged_rows} tickets staged", *checks, *broken, *figures])


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="casemart", description="Build the ticket warehouse.")
    parser.add_argument("source", help="folder of raw tickets")
    parser.add_argument("warehouse", help="folder that holds the warehouse's versions")
    parser.add_argument("--format", default="parquet", choices=["parquet", "csv", "json"])
    parser.add_argument("--as-of", help="date for backlog ages, yyyy-mm-dd; default today")
    parser.add_argument("--no-export", action="store_true", help="write no JSON")
    parser.add_argument(
        "--keep-unmatched", action="store_true", help="keep tickets that miss a dimension"
    )
    options = parser.parse_args(arguments)
    run = run_pipeline(
        session(),
        options.source,
        options.warehouse,
        options.as_of,
        export=not options.no_export,
        fmt=options.format,
        how="left" if options.keep_unmatched else "inner",
    )
    print(report(run))


if __name__ == "__main__":
    main()
