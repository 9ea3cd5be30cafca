"""CSV files whose quoted fields hold line breaks, read by many tasks.

Whether a line break ends a record depends on how many quotes stand before it in
the file, so Spark's multiLine mode reads a file in one task. Here the file is
read as lines, in splits:

1. each split counts its quotes; the parities of the splits before it say whether it
   starts inside a quoted field (one row per split);
2. within a split, a line starts a record if an even number of quotes stands before it;
3. lines that start no record are joined to the record before them, which may be in
   an earlier split. Records of one line are not grouped.

The lines are shuffled once, by split, so that each is counted in order; a task holds one split. That is the price
of a file that several tasks read; without line breaks in text, read_tickets shuffles nothing.

A quote inside a quoted field is written twice, as pandas and Spark (escape='"') do; quotes that are
not balanced make one record of the rest of the file, as they do for multiLine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from casemart.schema import RAW, RAW_COLUMNS
from casemart.sources.tickets import TEXT, typed


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """file, block, row (of the first line) and record (the text, line breaks included) of the records of CSV files.

    Ordered by file, block and row they are in the order of the files; the header, if there is one, is the first
    record of each file. Blank lines between records are records without text.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
        F.col("value"),
        (F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))).alias("quotes"),
    )
    # One row per split: whether it starts inside quotes.
    in_file = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    splits = lines.groupBy("file", "block").agg(F.sum("quotes").alias("own"))
    splits = splits.select("file", "block", (F.coalesce(F.sum("own").over(in_file), F.lit(0)) % 2).alias("before"))
    in_split = Window.partitionBy("file", "block").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    placed = lines.join(splits, ["file", "block"])
    opened = (F.col("before") + F.coalesce(F.sum("quotes").over(in_split), F.lit(0))) % 2 == 1
    placed = placed.withColumn("inside", opened)
    # The line that a record starts with: the last line before, in this split, that is not inside quotes.
    up_to_here = Window.partitionBy("file", "block").orderBy("row").rowsBetween(Window.unboundedPreceding, 0)
    placed = placed.withColumn("start", F.max(F.when(~F.col("inside"), F.col("row"))).over(up_to_here))
    # Lines before the first start of a split go on the last record that an earlier split starts.
    last = placed.groupBy("file", "block").agg(F.max("start").alias("last"))
    earlier = last.select("file", "block", F.last("last", ignorenulls=True).over(in_file).alias("open_start"))
    owned = placed.join(earlier, ["file", "block"]).withColumn("start", F.coalesce("start", "open_start"))
    # Whether the next line goes on: only then has a record several lines.
    odd = (F.col("quotes") % 2 == 1) | F.col("inside")
    single = owned.filter(~odd).select("file", "block", "row", F.col("value").alias("record"))
    several = (
        owned.filter(odd)
        .groupBy("file", F.col("start").alias("row"))
        .agg(
            F.min("block").alias("block"),
            F.array_sort(F.collect_list(F.struct("block", F.col("row").alias("line"), "value"))).alias("parts"),
        )
        .select("file", "block", "row", F.array_join(F.transform("parts", lambda part: part["value"]), "\n").alias("record"))
    )
    return single.union(several)


def read_quoted_tickets(spark: SparkSession, path: str) -> DataFrame:
    """Raw tickets of CSV files as pandas writes them, like read_tickets with multiLine=True, but files are split.

    The first record of each file must name the columns in order; a value that does not parse stops the read.
    """
    records = csv_records(spark, path).withColumn("record", F.regexp_replace("record", "\r$", "")).filter("record <> ''")
    heads = records.filter("block = 0").groupBy("file").agg(F.min("row").alias("head_row"), F.min_by("record", "row").alias("head"))
    names = F.replace("head", F.lit('"'), F.lit(""))
    wrong = F.raise_error(F.concat(F.lit("malformed header: "), "head")).cast("string")
    checked = F.when(names == ",".join(RAW_COLUMNS), F.col("record")).otherwise(wrong)
    rows = records.join(heads, "file").filter("NOT (block = 0 AND row = head_row)").withColumn("record", checked)
    parsed = F.from_csv("record", TEXT.toDDL(), {"mode": "FAILFAST", "escape": '"'}).alias("_ticket")
    cells = rows.select(parsed, "file", "block", "row").select("_ticket.*", "file", "block", "row")
    return cells.select(
        *[typed(field, "csv").alias(field.name) for field in RAW],
        F.col("file").alias("arrival_file"),
        F.col("block").alias("arrival_block"),
        F.col("row").alias("arrival_row"),
    )
