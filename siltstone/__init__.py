"""Spark-native engine for building, refreshing and querying vector-backed knowledge bases."""
