"""Spark-first sources."""
