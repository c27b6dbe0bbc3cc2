"""Spark-first analytics for drainage and waterway networks."""
