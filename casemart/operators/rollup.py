"""Additive sums of the fact at the grains that the marts need, from one scan.

The marts group by different keys, and a cube over all of them has about as many
rows as the fact. Grouping sets keep the grains apart: each row of the scan is
added to one group of each, map tasks send one row per group, and what is stored
is as small as the marts. Every mart then reads the rows of its own grain.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casemart.functions.numeric import part_sums

# The keys of each grain. The backlog is not among them: by department, type and day there are about as many groups as
# open tickets, and it reads three columns of the folders of open tickets.
GRAINS = {
    "teams": ["department_key", "status_key"],
    "days": ["created_date_key"],
    "places": ["location_key"],
    "kinds": ["request_type_key"],
}
GRAIN_KEYS = list(dict.fromkeys(key for keys in GRAINS.values() for key in keys))


def measures() -> list[Column]:
    """Additive measures; Spark drops the ones a mart does not use."""
    return [
        F.count(F.lit(1)).alias("n"),
        F.count_if("is_sla_breached").alias("breaches"),
        F.count_if("is_repeat_incident").alias("repeats"),
        *part_sums("resolution_time_hours", "hours"),
        F.count("resolution_time_hours").alias("n_hours"),
        *part_sums("target_sla_hours", "targets"),
        F.count("target_sla_hours").alias("n_targets"),
        F.sum("satisfaction_rating").alias("ratings"),
        F.count("satisfaction_rating").alias("n_ratings"),
    ]


def tally(fact: DataFrame, *keys: str) -> DataFrame:
    """The measures per key."""
    return fact.groupBy(*keys).agg(*measures())


def by_sets(table: DataFrame, sets: dict[str, list[str]], aggregates: list[Column]) -> DataFrame:
    """The aggregates per group of each set of columns, in one scan; `grain` names the set."""
    every = list(dict.fromkeys(key for keys in sets.values() for key in keys))
    # The grouping id has a bit for each column that is not in the set.
    ids = {
        name: sum(1 << (len(every) - 1 - place) for place, key in enumerate(every) if key not in keys)
        for name, keys in sets.items()
    }
    grain = F.lit(None).cast("string")
    for name, number in ids.items():
        grain = F.when(F.grouping_id() == number, F.lit(name)).otherwise(grain)
    grouped = table.groupingSets([[F.col(key) for key in keys] for keys in sets.values()], *[F.col(key) for key in every])
    return grouped.agg(*aggregates, grain.alias("grain"))


def mart_sums(fact: DataFrame) -> DataFrame:
    """The measures at every grain."""
    return by_sets(fact, GRAINS, measures())
