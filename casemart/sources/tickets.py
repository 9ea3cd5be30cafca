"""Read raw tickets from files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casemart.schema import RAW

# Where a row stood in the input: files by path, blocks by offset, rows as read.
ARRIVAL = ["arrival_file", "arrival_block", "arrival_row"]

# The schema of text files. A column of whole numbers with gaps is often written
# with decimals, 5.0 for 5.
TEXT = T.StructType(
    [
        T.StructField(field.name, T.DoubleType()) if field.dataType == T.IntegerType() else field
        for field in RAW
    ]
)


def read_tickets(
    spark: SparkSession, path: str, fmt: str = "parquet", escaped: bool = False, **options
) -> DataFrame:
    """Raw tickets with the fixed schema, plus the ARRIVAL columns.

    Spark keeps no row order, so the position in the input is recorded here.
    Within one block rows are read in order by one task, so the increasing id
    orders them; blocks and files are ordered by the columns before it.

    A CSV header must name the columns in order, and a value that does not parse
    stops the read instead of becoming NULL; `mode="PERMISSIVE"` lets it pass.
    Times may be written with a space or a T, ratings with a decimal point (but
    as whole numbers), and quotes are doubled, as pandas writes them. CSV does not
    tell empty text from missing text: both are read as NULL.

    Line breaks in the text of CSV files: `multiLine=True` reads quoted ones, at
    the price that a file is not split (`quoted.read_quoted_tickets` splits it); `escaped=True` turns the \\n of
    write_tickets back. Without either, a line break in text stops the read. All
    cells of a line are read, whatever columns are selected, so that a query of
    few columns fails as one of all columns does.
    """
    lenient = str(options.get("mode", "FAILFAST")).upper() == "PERMISSIVE"
    reader = spark.read.schema(RAW if fmt == "parquet" else TEXT)
    if fmt in ("csv", "json"):
        reader = reader.option("mode", "FAILFAST")
    if fmt == "csv":
        # columnPruning off: a malformed line is seen whatever columns are wanted.
        reader = reader.options(header=True, enforceSchema=False, escape='"', columnPruning=False)
    return (
        reader.options(**options)
        .format(fmt)
        .load(path)
        .select(
            *[typed(field, fmt, escaped, lenient).alias(field.name) for field in RAW],
            F.col("_metadata.file_path").alias("arrival_file"),
            F.col("_metadata.file_block_start").alias("arrival_block"),
            F.monotonically_increasing_id().alias("arrival_row"),
        )
    )


def typed(field: T.StructField, fmt: str, escaped: bool = False, lenient: bool = False) -> Column:
    """A column as the fixed schema has it."""
    column = F.col(field.name)
    if fmt != "parquet" and isinstance(field.dataType, T.IntegerType):
        whole = F.when(column == F.floor(column), column.cast(field.dataType))
        if lenient:
            return whole
        wrong = F.raise_error(F.concat(F.lit(f"malformed {field.name}: "), column.cast("string")))
        return F.when(column.isNull() | (column == F.floor(column)), whole).otherwise(
            wrong.cast(field.dataType)
        )
    if escaped and isinstance(field.dataType, T.StringType):
        # A mark that text can't hold stands in for a written backslash meanwhile.
        column = F.replace(column, F.lit("\\\\"), F.lit("\x00"))
        column = F.replace(F.replace(column, F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r"))
        return F.replace(column, F.lit("\x00"), F.lit("\\"))
    return column.cast(field.dataType)
