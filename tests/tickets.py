"""Small raw tickets for the tests."""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal

from pyspark.sql import Window
from pyspark.sql import functions as F

from casemart.operators import dimensions
from casemart.operators.fact import build_fact
from casemart.operators.star import Star
from casemart.schema import RAW

# A ticket of a made-up harbour town, closed after three hours.
DEFAULTS = {
    "ticket_number": "SR-4711",
    "created_date": datetime(2024, 5, 6, 8, 30),
    "closed_date": datetime(2024, 5, 6, 11, 30),
    "target_sla_hours": Decimal("48.00"),
    "department_name": "Harbour Office",
    "division_name": "Piers",
    "request_category": "Moorings",
    "request_type": "Loose Cleat",
    "priority_level": "Low",
    "status": "Closed - Resolved",
    "district_code": "DIST-01",
    "neighborhood": "Old Quay",
    "zip_code": "20457",
    "latitude": Decimal("53.540000"),
    "longitude": Decimal("9.980000"),
    "satisfaction_rating": 4,
    "is_repeat": False,
    "channel": "Phone",
}
ARRIVAL = ["arrival"]


def raw(spark, *rows):
    """Raw tickets: the defaults, changed by each row, in the order given."""
    tuples = [tuple({**DEFAULTS, **row}.values()) + (place,) for place, row in enumerate(rows)]
    fields = [(field.name, field.dataType.simpleString()) for field in RAW]
    ddl = ", ".join(f"{name} {kind}" for name, kind in [*fields, ("arrival", "int")])
    return spark.createDataFrame(tuples, ddl)


def numbered(*rows):
    """Give each row its own ticket number."""
    return [{"ticket_number": f"SR-{place}", **row} for place, row in enumerate(rows, 1)]


def keyed(name, rows):
    """The few rows of a dimension with their keys, in one task."""
    key, order = dimensions.KEYS[name]
    number = F.row_number().over(Window.orderBy(*order)).alias(key)
    return rows.select(number, *rows.columns)


def star(spark, *rows, how="inner"):
    """The star built from rows that are taken as already clean."""
    staging = raw(spark, *rows).drop("arrival").cache()
    parts = [
        keyed("dim_location", dimensions.dim_location(staging)),
        keyed("dim_request_type", dimensions.dim_request_type(staging)),
        keyed("dim_department", dimensions.dim_department(staging)),
        keyed("dim_status", dimensions.dim_status(staging)),
    ]
    return Star(
        build_fact(staging, *parts, how=how),
        dimensions.dim_date(dimensions.date_bounds(staging)),
        *parts,
    )
