"""Spark-native analytics over monthly trip records."""
