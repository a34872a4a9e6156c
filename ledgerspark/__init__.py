"""Spark-native analytics of government budget data."""
