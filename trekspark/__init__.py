"""Spark-native analytics for timestamped locations."""
