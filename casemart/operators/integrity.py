"""Declared constraints as checks: one row per rule with its violations."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casemart.functions.numeric import total
from casemart.operators.fact import attach_keys
from casemart.operators.rollup import by_sets
from casemart.operators.star import Star
from casemart.schema import FOREIGN_KEYS, NOT_NULL, NUMBER_LIMITS, TEXT_LIMITS, UNIQUE


def _rules(counts: DataFrame, names: Sequence[str]) -> DataFrame:
    """Turn one row of counts, `_0`, `_1`, ..., into (rule, violations) rows."""
    rows = [
        F.struct(F.lit(name).alias("rule"), F.col(f"_{place}").alias("violations"))
        for place, name in enumerate(names)
    ]
    return counts.select(F.inline(F.array(*rows)))


def _count_rules(table: DataFrame, rules: Sequence[tuple[str, Column]]) -> DataFrame:
    """Count the rows that break each rule, in one pass."""
    return rule_log(table.agg(*rule_counts(rules)), rules)


def rule_counts(rules: Sequence[tuple[str, Column]]) -> list[Column]:
    """The rows that break each rule: aggregates for `agg`, or for `observe` in a pass that writes the table."""
    return [F.count_if(broken).alias(f"_{place}") for place, (_, broken) in enumerate(rules)]


def rule_log(counts: DataFrame, rules: Sequence[tuple[str, Column]]) -> DataFrame:
    """The (rule, violations) rows of one row of `rule_counts`."""
    return _rules(counts, [name for name, _ in rules])


def _stack(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def unique_violations(table: DataFrame, keys: Sequence[str], rule: str) -> DataFrame:
    """Rows after the first of each key; as in SQL, a NULL in the key is exempt."""
    per_key = table.dropna(subset=list(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    return _rules(per_key.agg(total(F.col("_rows") - 1).alias("_0")), [rule])


def check_unique(tables: dict[str, DataFrame]) -> DataFrame:
    """Primary and unique keys of the tables given."""
    return _stack(
        [
            unique_violations(frame, keys, f"{name}({', '.join(keys)})")
            for name, frame in tables.items()
            for keys in UNIQUE[name]
            if set(keys) <= set(frame.columns)
        ]
    )


def not_null_rules(name: str, present: Sequence[str], columns: dict[str, list[str]] = NOT_NULL) -> list[tuple[str, Column]]:
    return [(f"{name}.{column}", F.col(column).isNull()) for column in columns.get(name, []) if column in present]


def text_rules(name: str, present: Sequence[str]) -> list[tuple[str, Column]]:
    limits = TEXT_LIMITS.get(name, {})
    return [(f"{name}.{column}", F.length(column) > limit) for column, limit in limits.items() if column in present]


def number_rules(name: str, present: Sequence[str]) -> list[tuple[str, Column]]:
    limits = NUMBER_LIMITS.get(name, {})
    return [
        (f"{name}.{column}", F.abs(F.col(column)) >= F.lit(10**whole)) for column, whole in limits.items() if column in present
    ]


def row_rules(name: str, present: Sequence[str]) -> list[tuple[str, Column]]:
    """All rules that a row of a table breaks by itself."""
    return [*not_null_rules(name, present), *text_rules(name, present), *number_rules(name, present)]


def check_not_null(
    tables: dict[str, DataFrame], columns: dict[str, list[str]] = NOT_NULL
) -> DataFrame:
    """Columns that must hold a value; one pass per table."""
    return _stack([_count_rules(frame, not_null_rules(name, frame.columns, columns)) for name, frame in tables.items()])


def check_text_limits(tables: dict[str, DataFrame]) -> DataFrame:
    """Text longer than its column allows; one pass per table."""
    return _stack([_count_rules(frame, text_rules(name, frame.columns)) for name, frame in tables.items()])


def check_number_ranges(tables: dict[str, DataFrame]) -> DataFrame:
    """Numbers with more whole digits than their column allows; one pass per table.

    A value that its type can't hold never gets into a stored table; this is for
    tables read with wider types.
    """
    return _stack(
        [_count_rules(frame, number_rules(name, frame.columns)) for name, frame in tables.items() if name in NUMBER_LIMITS]
    )


def check_rows(tables: dict[str, DataFrame]) -> DataFrame:
    """All rules that rows break by themselves; one pass per table."""
    return _stack([_count_rules(frame, row_rules(name, frame.columns)) for name, frame in tables.items()])


def check_foreign_keys(star: Star) -> DataFrame:
    """Fact rows whose key has no dimension row; a NULL key is exempt.

    One scan counts the fact per key, for all foreign keys at once; those counts are
    anti-joined with the keys of all dimensions, so no fact row is joined.
    """
    tables = star.tables()
    rules = {f"{column} -> {dimension}": (column, dimension, key) for column, dimension, key in FOREIGN_KEYS}
    rows = F.count(F.lit(1)).alias("_rows")
    counted = by_sets(star.fact, {rule: [column] for rule, (column, _, _) in rules.items()}, [rows])
    # A row has the key of its own set; the other columns are NULL.
    used = counted.select("grain", F.coalesce(*{column: F.col(column) for column, _, _ in rules.values()}.values()).alias("key"), "_rows")
    known = _stack(
        [tables[dimension].select(F.lit(rule).alias("grain"), F.col(key).alias("key")) for rule, (_, dimension, key) in rules.items()]
    )
    orphans = used.filter(F.col("key").isNotNull()).join(known, ["grain", "key"], "left_anti")
    sums = [total(F.when(F.col("grain") == rule, F.col("_rows"))).alias(f"_{place}") for place, rule in enumerate(rules)]
    return _rules(orphans.agg(*sums), list(rules))


#: Groups of tickets that are compared by their sums.
BUCKETS = 4096


def _bucket(buckets: int) -> Column:
    return F.pmod(F.hash("ticket_number"), F.lit(buckets)).alias("_bucket")


def _summary(table: DataFrame, buckets: int, name: str) -> DataFrame:
    """Per bucket, the rows and the sum of the 64-bit hashes of their ticket numbers, as one struct."""
    # The halves are added up apart, so that no sum overflows before two billion rows of a bucket.
    number = F.xxhash64("ticket_number")
    low, high = F.sum(number.bitwiseAND(F.lit((1 << 32) - 1))), F.sum(F.shiftright(number, 32))
    sums = table.groupBy(_bucket(buckets)).agg(F.count(F.lit(1)).alias("n"), low.alias("low"), high.alias("high"))
    return sums.select("_bucket", F.struct("n", "low", "high").alias(name))


def lost_tickets(staging: DataFrame, fact: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """One row: the staged rows that are not in the fact; a missing ticket number counts as a number.

    Both tables are summed up in buckets of ticket numbers; a map task sends one row per bucket. Only buckets that
    differ are counted per ticket number and joined; if none does, adaptive execution leaves that out. Equal counts and
    sums of hashes are taken as equal tickets (of buckets that differ, one in 2^64 is missed).
    """
    both = _summary(staging, buckets, "_staged_sum").join(_summary(fact, buckets, "_stored_sum"), "_bucket", "left")
    # One row per bucket at most, so it can be broadcast.
    unequal = F.broadcast(both.filter(~F.col("_staged_sum").eqNullSafe(F.col("_stored_sum"))).select("_bucket"))

    def per_ticket(table: DataFrame, name: str) -> DataFrame:
        kept = table.select("ticket_number", _bucket(buckets)).join(unequal, "_bucket", "left_semi")
        return kept.groupBy("ticket_number").agg(F.count(F.lit(1)).alias(name))

    staged = per_ticket(staging, "_staged")
    stored = per_ticket(fact, "_stored").withColumnRenamed("ticket_number", "_ticket")
    joined = staged.join(stored, F.col("ticket_number").eqNullSafe(F.col("_ticket")), "left")
    lost = F.greatest(F.col("_staged") - F.coalesce(F.col("_stored"), F.lit(0)), F.lit(0))
    return joined.agg(total(lost).alias("_0"))


def check_lost_tickets(staging: DataFrame, star: Star) -> DataFrame:
    """Staged tickets without a dimension row, by dimension, and those that are not in the fact.

    The keys are looked up again with outer joins, in one scan of staging.
    """
    keyed = attach_keys(
        staging, star.locations, star.request_types, star.departments, star.statuses, "left"
    )
    keys = ["location_key", "request_type_key", "department_key", "status_key"]
    missing = _count_rules(keyed, [(f"no {key}", F.col(key).isNull()) for key in keys])
    return _stack([missing, _rules(lost_tickets(staging, star.fact), ["lost tickets"])])


def zip_codes_per_location(staging: DataFrame) -> DataFrame:
    """Zip codes per district and neighborhood; more than one is a conflict."""
    return (
        staging.groupBy("district_code", "neighborhood")
        .agg(F.count_distinct("zip_code").alias("zip_codes"))
        .withColumn("is_conflict", F.col("zip_codes") > 1)
    )


def location_conflicts(staging: DataFrame) -> DataFrame:
    """The locations that have several zip codes."""
    return zip_codes_per_location(staging).filter("is_conflict").drop("is_conflict")
