"""Spark-native batch analytics for title-catalog data."""
