"""Spark-native change-data ingestion and training-data engine."""

__version__ = "1.0.3"
