"""Data quality audit: missing values, time order and ticket uniqueness."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casemart.functions.numeric import total

# The mandatory columns and the texts of the audit log.
MANDATORY = ["ticket_number", "created_date", "department_name", "request_category"]
NULL_CHECK = "Null Check: {column}"
NULL_DETAILS = "Found %d nulls out of %d rows"
TIME_CHECK = "Timestamp Logic Check (closed >= created)"
TIME_DETAILS = "Found %d tickets with closed_date before created_date"
UNIQUE_CHECK = "Uniqueness Check (ticket_number)"
UNIQUE_DETAILS = "Found %d duplicate ticket numbers"


def _log_row(check: str, bad: Column, details: Column) -> Column:
    return F.struct(
        F.lit(check).alias("check_name"),
        F.when(bad == 0, "PASSED").otherwise("FAILED").alias("status"),
        details.alias("details"),
    )


def _missing(schema: T.StructType, name: str) -> Column:
    column = F.col(name)
    if isinstance(schema[name].dataType, (T.FloatType, T.DoubleType)):
        return column.isNull() | F.isnan(column)
    return column.isNull()


def _unpivot(counts: DataFrame, rows: list[Column]) -> DataFrame:
    return counts.select(F.inline(F.array(*rows)))


def row_counts(schema: T.StructType, columns: Sequence[str] = tuple(MANDATORY), with_time: bool = True) -> list[Column]:
    """What the null and time checks count: aggregates for `agg`, or for `observe` in a pass that writes the tickets."""
    counts = [F.count(F.lit(1)).alias("_rows")]
    counts += [F.count_if(_missing(schema, name)).alias(f"_null_{name}") for name in columns if name in schema.names]
    if with_time:
        counts.append(F.count_if(F.col("closed_date") < F.col("created_date")).alias("_early"))
    return counts


def row_log(counts: DataFrame) -> DataFrame:
    """The log rows of one row of `row_counts`."""
    rows = []
    for name in counts.columns:
        if name.startswith("_null_"):
            check = NULL_CHECK.format(column=name.removeprefix("_null_"))
            rows.append(_log_row(check, F.col(name), F.format_string(NULL_DETAILS, F.col(name), F.col("_rows"))))
        elif name == "_early":
            rows.append(_log_row(TIME_CHECK, F.col(name), F.format_string(TIME_DETAILS, F.col(name))))
    return _unpivot(counts, rows)


def _row_checks(tickets: DataFrame, columns: Sequence[str], with_time: bool) -> DataFrame:
    return row_log(tickets.agg(*row_counts(tickets.schema, columns, with_time)))


def check_nulls(tickets: DataFrame, columns: Sequence[str] = tuple(MANDATORY)) -> DataFrame:
    """One log row per mandatory column; a column the table lacks is skipped."""
    return _row_checks(tickets, columns, with_time=False)


def check_time_order(tickets: DataFrame) -> DataFrame:
    """Count tickets closed before they were created; equal times pass."""
    return _row_checks(tickets, [], with_time=True)


def check_rows(tickets: DataFrame) -> DataFrame:
    """The null and time checks, in one pass without a shuffle of the tickets."""
    return _row_checks(tickets, MANDATORY, with_time=True)


def check_uniqueness(tickets: DataFrame) -> DataFrame:
    """Count the rows after the first of each ticket number; NULL is one number."""
    per_ticket = tickets.groupBy("ticket_number").agg(F.count(F.lit(1)).alias("_rows"))
    extra = per_ticket.agg(total(F.col("_rows") - 1).alias("_extra"))
    return _unpivot(
        extra,
        [_log_row(UNIQUE_CHECK, F.col("_extra"), F.format_string(UNIQUE_DETAILS, F.col("_extra")))],
    )


def audit(tickets: DataFrame) -> DataFrame:
    """The whole log: the null and time checks in one pass, then uniqueness."""
    return check_rows(tickets).unionByName(check_uniqueness(tickets))


def passed(log: DataFrame) -> DataFrame:
    """One row: whether every check in the log passed."""
    return log.agg(F.coalesce(F.bool_and(F.col("status") == "PASSED"), F.lit(True)).alias("passed"))
