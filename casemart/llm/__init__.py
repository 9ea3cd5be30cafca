"""Operators of a training-data pipeline over documents, pages and benchmarks.

Each module holds one operator. `catalogue` registers the queries, `oracle` their
SQL. Nothing outside this package imports it; `__spark_entry__` looks for it.
"""
