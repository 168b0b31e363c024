"""Spark-native analytics over multi-source activity records."""
