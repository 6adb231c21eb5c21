"""Layered data pipelines on Spark, as functions from DataFrame to DataFrame."""
