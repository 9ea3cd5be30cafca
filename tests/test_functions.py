from datetime import datetime
from decimal import ROUND_HALF_UP, Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from casemart.functions.numeric import (
    decimal_ratio,
    exact_sum,
    hours_between,
    part_sums,
    percentage,
    ratio,
    whole_sum,
)
from casemart.functions.text import WHITESPACE, grouped_digits, place_label, strip


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def money(text):
    return F.lit(Decimal(text)).cast("decimal(20,2)")


def test_whitespace_is_what_python_strips():
    assert set(WHITESPACE) == {chr(code) for code in range(0x110000) if chr(code).isspace()}


@pytest.mark.parametrize("text", ["\t Roads \n", "  Roads 　", "\x1cRoads\x1f", "", " "])
def test_strip_matches_python(spark, text):
    assert one(spark, strip(F.lit(text))) == text.strip()


def test_strip_keeps_null_and_inner_space(spark):
    assert one(spark, strip(F.lit(None).cast("string"))) is None
    assert one(spark, strip(F.lit(" Public  Works "))) == "Public  Works"


def test_ratio_rounds_half_away_from_zero(spark):
    assert one(spark, ratio(money("2.01"), F.lit(2))) == 1.01
    assert one(spark, ratio(money("-2.01"), F.lit(2))) == -1.01
    assert one(spark, ratio(money("1.00"), F.lit(3))) == 0.33
    assert one(spark, ratio(money("0.00"), F.lit(3))) == 0.0


def test_ratio_of_nothing_is_null(spark):
    assert one(spark, ratio(money("1.00"), F.lit(0))) is None
    assert one(spark, ratio(F.lit(None).cast("decimal(20,2)"), F.lit(0))) is None
    assert one(spark, percentage(F.lit(0), F.lit(0))) is None


def test_ratio_is_exact_for_huge_counts(spark):
    # 0.005 less a part in 10**13: a cut-off quotient would round it up.
    count = 200 * 10**11
    total = Decimal(count) * Decimal("0.005") - Decimal("0.01")
    assert one(spark, ratio(F.lit(total).cast("decimal(30,2)"), F.lit(count))) == 0.0
    assert one(spark, ratio(F.lit(total + Decimal("0.01")).cast("decimal(30,2)"), F.lit(count))) == 0.01


def test_percentage_can_shrink(spark):
    assert one(spark, percentage(F.lit(-1), F.lit(3))) == -33.33


def test_decimal_ratio_keeps_six_digits(spark):
    value = one(spark, decimal_ratio(F.lit(Decimal("65.200001")), F.lit(2), 6))
    assert value == Decimal("32.600001")


@settings(max_examples=25, deadline=None)
@given(
    rows=st.lists(
        st.tuples(st.integers(-(10**12), 10**12), st.integers(1, 10**9)), min_size=1, max_size=30
    )
)
def test_ratio_matches_python_decimals(spark, rows):
    frame = spark.createDataFrame(
        [(place, Decimal(cents).scaleb(-2), count) for place, (cents, count) in enumerate(rows)],
        "place int, total decimal(20,2), n bigint",
    )
    found = frame.select("place", ratio(F.col("total"), F.col("n")).alias("x")).collect()
    for row in found:
        cents, count = rows[row["place"]]
        exact = (Decimal(cents) / 100 / count).quantize(Decimal("0.01"), ROUND_HALF_UP)
        assert row["x"] == float(exact)


@settings(max_examples=15, deadline=None)
@given(
    cents=st.lists(st.one_of(st.none(), st.integers(-(10**10) + 1, 10**10 - 1)), min_size=1, max_size=40)
)
def test_cents_add_up_exactly(spark, cents):
    rows = [(place % 3, None if c is None else Decimal(c).scaleb(-2)) for place, c in enumerate(cents)]
    frame = spark.createDataFrame(rows, "k int, x decimal(10,2)")
    found = frame.groupBy("k").agg(*part_sums("x", "x")).agg(whole_sum("x").alias("x")).first()["x"]
    known = [c for c in cents if c is not None]
    assert found == (Decimal(sum(known)).scaleb(-2) if known else None)


def test_degrees_add_up_exactly(spark):
    degrees = [Decimal("9999.999999"), Decimal("-85.480001"), None, Decimal("0.000001")]
    frame = spark.createDataFrame([(value,) for value in degrees], "x decimal(10,6)")
    found = frame.agg(exact_sum("x", 6).alias("x")).first()["x"]
    assert found == sum(value for value in degrees if value is not None)


def test_sums_of_the_largest_values_do_not_overflow(spark):
    # 10**9 rows per key of the largest hours: more cents than a long can hold.
    largest = F.lit(Decimal("99999999.99")).cast("decimal(10,2)")
    per_key = spark.range(1).select(largest.alias("x")).agg(*part_sums("x", "x"))
    many = per_key.select(*[(F.col(name) * 10**9).alias(name) for name in per_key.columns])
    assert many.agg(whole_sum("x").alias("x")).first()["x"] == Decimal("99999999990000000")


def test_hours_ignore_the_session_zone(spark):
    # 02:30 does not exist on this day in New York.
    frame = spark.createDataFrame(
        [(datetime(2025, 3, 9, 0, 30), datetime(2025, 3, 9, 2, 30))],
        "a timestamp_ntz, b timestamp_ntz",
    )
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        row = frame.select(
            hours_between(F.col("a"), F.col("b")).alias("on"),
            hours_between(F.col("b"), F.col("a")).alias("back"),
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert (row["on"], row["back"]) == (2, -2)


def test_labels(spark):
    assert one(spark, place_label(F.lit("DIST-01"), F.lit("Old Town"))) == "DIST-01 (Old Town)"
    assert one(spark, place_label(F.lit("DIST-01"), F.lit(None).cast("string"))) == "DIST-01"
    assert one(spark, grouped_digits(F.lit(1234567))) == "1,234,567"
