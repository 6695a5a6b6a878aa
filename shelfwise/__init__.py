"""Recommendation analytics as Spark DataFrame operators."""
