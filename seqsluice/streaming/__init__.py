"""Spark-first streaming."""
