"""Spark-native clip curation analytics."""

__version__ = "0.1.0"
