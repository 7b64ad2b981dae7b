"""Spark-native bronze/silver/gold catalogue library."""

__version__ = "0.1.0"
