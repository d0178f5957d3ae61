"""Spark-native preparation and evaluation of retrieval and conversation training data."""

__version__ = "0.1.0"
