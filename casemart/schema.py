"""Table schemas and the constraints that the integrity checks report on."""

from __future__ import annotations

from pyspark.sql import types as T

_money = T.DecimalType(10, 2)
_degrees = T.DecimalType(10, 6)

RAW = T.StructType(
    [
        T.StructField("ticket_number", T.StringType()),
        T.StructField("created_date", T.TimestampNTZType()),
        T.StructField("closed_date", T.TimestampNTZType()),
        T.StructField("target_sla_hours", _money),
        T.StructField("department_name", T.StringType()),
        T.StructField("division_name", T.StringType()),
        T.StructField("request_category", T.StringType()),
        T.StructField("request_type", T.StringType()),
        T.StructField("priority_level", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("district_code", T.StringType()),
        T.StructField("neighborhood", T.StringType()),
        T.StructField("zip_code", T.StringType()),
        T.StructField("latitude", _degrees),
        T.StructField("longitude", _degrees),
        T.StructField("satisfaction_rating", T.IntegerType()),
        T.StructField("is_repeat", T.BooleanType()),
        T.StructField("channel", T.StringType()),
    ]
)
RAW_COLUMNS = RAW.fieldNames()

TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"

# Declared constraints, table by table. Spark enforces none of these, so
# operators.integrity turns each one into a count of violations.

# PRIMARY KEY and UNIQUE column sets.
UNIQUE = {
    "staging": [["raw_id"]],
    "dim_date": [["date_key"], ["full_date"]],
    "dim_location": [["location_key"], ["district_code", "neighborhood"]],
    "dim_request_type": [
        ["request_type_key"],
        ["request_category", "request_type_name", "priority_level"],
    ],
    "dim_department": [["department_key"], ["department_name", "division_name"]],
    "dim_status": [["status_key"], ["status_name"]],
    "fact_service_requests": [["fact_id"], ["ticket_number"]],
}

NOT_NULL = {
    "dim_date": [
        "date_key", "full_date", "year", "quarter", "quarter_name", "month",
        "month_name", "day_of_month", "day_of_week", "day_name", "is_weekend",
        "fiscal_year", "fiscal_quarter",
    ],
    "dim_location": ["location_key", "district_code", "neighborhood", "region_zone"],
    "dim_request_type": [
        "request_type_key", "request_category", "request_type_name",
        "priority_level", "default_sla_hours",
    ],
    "dim_department": ["department_key", "department_name", "division_name"],
    "dim_status": ["status_key", "status_name", "is_closed", "is_active"],
    "fact_service_requests": [
        "fact_id", "ticket_number", "created_date_key", "location_key",
        "request_type_key", "department_key", "status_key", "created_timestamp",
        "target_sla_hours", "is_sla_breached", "is_repeat_incident",
    ],
}

# (fact column, dimension, dimension key). closed_date_key may be null.
FOREIGN_KEYS = [
    ("created_date_key", "dim_date", "date_key"),
    ("closed_date_key", "dim_date", "date_key"),
    ("location_key", "dim_location", "location_key"),
    ("request_type_key", "dim_request_type", "request_type_key"),
    ("department_key", "dim_department", "department_key"),
    ("status_key", "dim_status", "status_key"),
]

# VARCHAR(n) limits.
TEXT_LIMITS = {
    "staging": {
        "ticket_number": 50, "department_name": 100, "division_name": 100,
        "request_category": 100, "request_type": 150, "priority_level": 20,
        "status": 50, "district_code": 20, "neighborhood": 100, "zip_code": 20,
        "channel": 50,
    },
    "dim_date": {"quarter_name": 10, "month_name": 20, "day_name": 20},
    "dim_location": {
        "district_code": 20, "neighborhood": 100, "zip_code": 20, "region_zone": 50,
    },
    "dim_request_type": {
        "request_category": 100, "request_type_name": 150, "priority_level": 20,
    },
    "dim_department": {
        "department_name": 100, "division_name": 100, "department_head": 100,
    },
    "dim_status": {"status_name": 50},
    "fact_service_requests": {"ticket_number": 50},
}

# Whole digits of NUMERIC(precision, scale) columns.
NUMBER_LIMITS = {
    "staging": {"target_sla_hours": 8, "latitude": 4, "longitude": 4},
    "dim_location": {"latitude": 4, "longitude": 4},
    "dim_request_type": {"default_sla_hours": 8},
    "fact_service_requests": {
        "resolution_time_hours": 8, "target_sla_hours": 8, "sla_variance_hours": 8,
    },
}

# Column types of the stored tables, as DDL. raw_id, fact_id and the load times
# are added when a table is written; is_open and created_month are the fact's folders, grain those of
# the sums of the fact that the marts read.
TABLES = {
    "staging": (
        "raw_id BIGINT, ticket_number STRING, created_date TIMESTAMP_NTZ, "
        "closed_date TIMESTAMP_NTZ, target_sla_hours DECIMAL(10,2), department_name STRING, "
        "division_name STRING, request_category STRING, request_type STRING, "
        "priority_level STRING, status STRING, district_code STRING, neighborhood STRING, "
        "zip_code STRING, latitude DECIMAL(10,6), longitude DECIMAL(10,6), "
        "satisfaction_rating INT, is_repeat BOOLEAN, channel STRING, ingested_at TIMESTAMP"
    ),
    "dim_date": (
        "date_key INT, full_date DATE, year INT, quarter INT, quarter_name STRING, month INT, "
        "month_name STRING, day_of_month INT, day_of_week INT, day_name STRING, "
        "is_weekend BOOLEAN, fiscal_year INT, fiscal_quarter INT"
    ),
    "dim_location": (
        "location_key INT, district_code STRING, neighborhood STRING, zip_code STRING, "
        "latitude DECIMAL(10,6), longitude DECIMAL(10,6), region_zone STRING"
    ),
    "dim_request_type": (
        "request_type_key INT, request_category STRING, request_type_name STRING, "
        "priority_level STRING, default_sla_hours DECIMAL(10,2)"
    ),
    "dim_department": (
        "department_key INT, department_name STRING, division_name STRING, "
        "department_head STRING, team_capacity INT"
    ),
    "dim_status": "status_key INT, status_name STRING, is_closed BOOLEAN, is_active BOOLEAN",
    "fact_service_requests": (
        "fact_id BIGINT, ticket_number STRING, created_date_key INT, closed_date_key INT, "
        "location_key INT, request_type_key INT, department_key INT, status_key INT, "
        "created_timestamp TIMESTAMP_NTZ, closed_timestamp TIMESTAMP_NTZ, "
        "resolution_time_hours DECIMAL(10,2), target_sla_hours DECIMAL(10,2), "
        "sla_variance_hours DECIMAL(10,2), is_sla_breached BOOLEAN, "
        "is_repeat_incident BOOLEAN, satisfaction_rating INT, created_at TIMESTAMP, "
        "is_open INT, created_month INT"
    ),
    "mart_sums": (
        "department_key INT, status_key INT, created_date_key INT, location_key INT, "
        "request_type_key INT, n BIGINT, breaches BIGINT, repeats BIGINT, "
        "hours_high BIGINT, hours_low BIGINT, n_hours BIGINT, targets_high BIGINT, "
        "targets_low BIGINT, n_targets BIGINT, ratings BIGINT, n_ratings BIGINT, grain STRING"
    ),
}
