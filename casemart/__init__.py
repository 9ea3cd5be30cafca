"""casemart: a service-ticket warehouse and KPI marts on Spark DataFrames."""

from casemart.operators.marts import (
    backlog_aging,
    category_breakdown,
    department_performance,
    geographic_distribution,
    monthly_trends,
    operational_overview,
)
from casemart.plans.pipeline import run_pipeline
from casemart.plans.warehouse import Star, Warehouse, open_views, open_warehouse

__all__ = [
    "Star",
    "Warehouse",
    "backlog_aging",
    "category_breakdown",
    "department_performance",
    "geographic_distribution",
    "monthly_trends",
    "open_views",
    "open_warehouse",
    "operational_overview",
    "run_pipeline",
]
