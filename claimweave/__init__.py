"""Spark-native operators for health-claims analytics."""

__version__ = "0.1.0"
