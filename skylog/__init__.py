"""Spark-native analytics for hourly (or any fixed-interval) observation data."""

__version__ = "0.1.0"
