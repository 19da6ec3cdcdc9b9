"""Cohort building and survival analytics as Spark DataFrame operations."""
