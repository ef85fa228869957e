"""Spark-native engine: nested JSON to snippets, a property graph, retrieval, and corpus preparation."""

__version__ = "0.1.0"
