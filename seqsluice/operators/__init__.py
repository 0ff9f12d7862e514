"""Spark-first operators."""
