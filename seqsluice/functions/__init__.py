"""Spark-first functions."""
