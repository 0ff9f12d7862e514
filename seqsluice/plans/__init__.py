"""Spark-first plans."""
