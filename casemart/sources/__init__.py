"""Readers for raw tickets and for the tables tickets are derived from."""
