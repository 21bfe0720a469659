"""Spark-native transcript redaction analytics."""
