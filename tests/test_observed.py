"""Counts of the pass that writes a table, with tasks that fail after they have counted."""

import os
import subprocess
import sys
from pathlib import Path

from casemart.operators.audit import row_counts, row_log
from casemart.plans.warehouse import one_row, write_counted
from tickets import numbered, raw

RETRIED = """
import sys
from pyspark import TaskContext
from pyspark.sql import SparkSession, functions as F
from casemart.plans.warehouse import write_counted

spark = SparkSession.builder.master("local[2,3]").config("spark.ui.enabled", "false").getOrCreate()
tries = spark.sparkContext.accumulator(0)
counts = [F.count(F.lit(1)).alias("rows"), F.count_if(F.expr("id % 10 = 3")).alias("threes"), F.sum("id").alias("total")]


class Failing:
    # The frame that is observed and then written by way of a step that fails at its first attempt.
    def __init__(self, frame):
        self.frame = frame

    def observe(self, *what):
        def step(batches):
            for batch in batches:
                yield batch
            tries.add(1)
            if TaskContext.get().attemptNumber() == 0:
                raise RuntimeError("lost")

        return self.frame.observe(*what).mapInArrow(step, self.frame.schema)


found = write_counted(Failing(spark.range(0, 1000, 1, 4)), sys.argv[1], counts)
assert found == {"rows": 1000, "threes": 100, "total": 499500}, found
assert spark.read.parquet(sys.argv[1]).count() == 1000
# Tasks that failed have counted their rows too.
print("retried", found["rows"])
spark.stop()
"""


def test_a_retried_task_counts_once(tmp_path):
    root = str(Path(__file__).resolve().parents[1])
    done = subprocess.run(
        [sys.executable, "-c", RETRIED, str(tmp_path / "table")],
        capture_output=True, text=True, timeout=240, env={**os.environ, "PYTHONPATH": root},
    )
    assert done.returncode == 0, done.stderr[-2000:]
    assert "retried 1000" in done.stdout and "RuntimeError: lost" in done.stderr


def test_counts_of_a_write_equal_a_scan(spark, tmp_path):
    rows = numbered({}, {"department_name": None}, {"closed_date": None, "ticket_number": None})
    tickets = raw(spark, *rows)
    counts = row_counts(tickets.schema)
    path = str(tmp_path / "tickets")
    found = write_counted(tickets, path, counts)
    assert found == spark.read.parquet(path).agg(*counts).first().asDict()
    assert found["_rows"] == 3 and found["_null_department_name"] == 1
    assert row_log(one_row(spark, found)).filter("status = 'FAILED'").count() == 2


def test_counts_of_no_rows(spark, tmp_path):
    tickets = raw(spark, {}).limit(0)
    found = write_counted(tickets, str(tmp_path / "none"), row_counts(tickets.schema))
    assert set(found.values()) == {0}
