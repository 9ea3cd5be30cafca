"""Whole jobs: warehouse builds, the batch pipeline and the query catalogue."""
