"""Spark-native analytics for short-term rental market data."""

__version__ = "0.1.0"
