"""Spark-native analytics for sports tracking tables."""
