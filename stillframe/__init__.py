"""Spark-native analytics over batches of product photographs."""

__version__ = "0.1.0"
