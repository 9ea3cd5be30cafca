"""Exports: tickets as CSV, marts as JSON, and the dashboard payload."""

from __future__ import annotations

from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casemart.operators.marts import VIEWS
from casemart.schema import RAW, TIMESTAMP_FORMAT
from casemart.session import together

# The sections of the payload, in the order of the marts.
SECTIONS = [
    "overview",
    "departments",
    "monthly_trends",
    "geo_distribution",
    "categories",
    "backlog_aging",
]

def write_tickets(tickets: DataFrame, path: str) -> None:
    """Raw tickets as CSV with a header; spaces around text are kept.

    Line breaks in text are written as \\n and \\r, and backslashes as \\\\, so
    that a ticket is one line and the files can be split; read_tickets with
    escaped=True turns them back.
    """
    (
        tickets.select(*[_escaped(field) for field in RAW])
        .write.mode("overwrite")
        .options(
            header=True,
            timestampNTZFormat=TIMESTAMP_FORMAT,
            ignoreLeadingWhiteSpace=False,
            ignoreTrailingWhiteSpace=False,
            escape='"',
        )
        .csv(path)
    )


def _escaped(field: T.StructField) -> Column:
    column = F.col(field.name)
    if not isinstance(field.dataType, T.StringType):
        return column
    for found, written in [("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r")]:
        column = F.replace(column, F.lit(found), F.lit(written))
    return column.alias(field.name)


def plain(mart: DataFrame) -> DataFrame:
    """Decimals as doubles, dates and times as text: types JSON readers know."""

    def convert(field: T.StructField) -> Column:
        column = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            column = column.cast("string")
        return column.alias(field.name)

    return mart.select(*[convert(field) for field in mart.schema])


def write_marts(marts: dict[str, DataFrame], folder: str) -> None:
    """Each mart as a folder of JSON lines, of any size; missing values are null."""

    def write(name: str, mart: DataFrame) -> None:
        plain(mart).write.mode("overwrite").option("ignoreNullFields", False).json(f"{folder}/{name}")

    spark = next(iter(marts.values())).sparkSession
    together(spark, *[partial(write, name, mart) for name, mart in marts.items()])


def _section_order(section: str) -> list[Column]:
    return {
        "departments": [F.col("department_name"), F.col("division_name")],
        "monthly_trends": [F.col("year"), F.col("month")],
        "geo_distribution": [
            -F.col("total_requests"), F.col("district_code"), F.col("neighborhood"),
        ],
        "categories": [
            -F.col("request_count"), F.col("request_category"),
            F.col("request_type_name"), F.col("priority_level"),
        ],
        "backlog_aging": [F.col("department_name"), F.col("request_category")],
    }[section]


def _record(frame: DataFrame) -> Column:
    return F.to_json(F.struct(*frame.columns), {"ignoreNullFields": "false"})


def _one_line(spark: SparkSession, text: str) -> DataFrame:
    return spark.range(0, 1, 1, 1).select(F.lit(text).alias("line"))


def payload_lines(marts: dict[str, DataFrame], indent: bool = False) -> DataFrame:
    """The payload as the lines of a JSON document, one record per line, in order.

    The overview is an object, or {} if there is none; the other sections are lists
    of records. Each section is sorted by range, so no task holds one, and the
    partitions follow each other in the order of the document. `indent` sets the
    records off from the lines that open and close the lists.

    All records but the first of a section have a comma before them. The first one is the first row of the first range,
    which is never empty: ranges end at keys that are there, and adaptive execution only joins neighbours.
    """
    frames = {section: plain(marts[view]) for section, view in zip(SECTIONS, VIEWS, strict=True)}
    overview = frames["overview"]
    spark = overview.sparkSession
    only = overview.agg(F.coalesce(F.first(_record(overview)), F.lit("{}")).alias("only"))
    parts = [only.select(F.concat(F.lit('{"overview":'), "only", F.lit(",")).alias("line"))]
    for section in SECTIONS[1:]:
        frame = frames[section]
        placed = frame.orderBy(*_section_order(section)).select(_record(frame).alias("_record"), F.monotonically_increasing_id().alias("_place"))
        comma = F.when(F.col("_place") == 0, F.lit(" " * indent)).otherwise(F.lit(","))
        parts.append(_one_line(spark, f'"{section}":['))
        parts.append(placed.select(F.concat(F.lit("  " * indent), comma, "_record").alias("line")))
        parts.append(_one_line(spark, "]}" if section == SECTIONS[-1] else "],"))
    return reduce(DataFrame.union, parts)


def write_payload(marts: dict[str, DataFrame], path: str, indent: bool = True) -> None:
    """The payload as text files in the folder `path`; read in the order of their
    names they are the document.

    The marts are computed once for the ranges of their sort and once for the rows: give stored ones.
    """
    payload_lines(marts, indent).write.mode("overwrite").text(path)


def read_payload(spark: SparkSession, path: str) -> DataFrame:
    """The records of a payload: section, position (from 1), record (JSON text).

    Lines are numbered by the number of lines in the stretches of files before theirs and their place in their own; a scan
    returns the lines of a stretch in order, so nothing is sorted. One row per stretch is summed up in one task, and only
    the six lines that open a section reach the driver.
    """
    lines = spark.read.text(path).select(
        F.col("value"),
        F.col("_metadata.file_name").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
    stretches = lines.groupBy("file", "block").agg(F.min("row").alias("first_row"), F.count(F.lit(1)).alias("size"))
    before = Window.orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stretches.select("file", "block", "first_row", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset"))
    line = (F.col("offset") + F.col("row") - F.col("first_row") + 1).alias("line")
    numbered = lines.join(offsets, ["file", "block"]).select("value", line)
    opening = F.regexp_extract("value", r'^\{?"(\w+)":', 1)
    opens = numbered.filter(F.col("value").rlike(r'^(\{"overview":|"\w+":\[$)'))
    starts = sorted((row["line"], row["section"]) for row in opens.select("line", opening.alias("section")).collect())
    section, start = F.lit(None).cast("string"), F.lit(None).cast("bigint")
    for at, name in starts:
        after = F.col("line") >= at
        section = F.when(after, F.lit(name)).otherwise(section)
        start = F.when(after, F.lit(at)).otherwise(start)
    of = numbered.select("line", "value", section.alias("section"), start.alias("start"))
    overview = F.regexp_extract("value", r'^\{"overview":(.*),$', 1)
    record = F.when(F.col("value").startswith('{"overview":'), F.nullif(overview, F.lit("{}"))).when(
        F.col("value").rlike(r"^[ ,]*\{"), F.regexp_replace("value", r"^[ ,]+", "")
    )
    position = F.when(F.col("section") == "overview", F.lit(1)).otherwise(F.col("line") - F.col("start"))
    return of.select("section", position.cast("bigint").alias("position"), record.alias("record")).filter(
        "record IS NOT NULL"
    )


def payload_section(records: DataFrame, section: str, schema: T.StructType) -> DataFrame:
    """position and the columns of one section's records."""
    own = records.filter(F.col("section") == section)
    parsed = F.from_json("record", schema, {"mode": "FAILFAST"})
    return own.select("position", parsed.alias("_record")).select("position", "_record.*")
