"""Spark-native analytics over market documents and daily series."""
