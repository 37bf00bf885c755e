"""Spark-native entity resolution and analytics."""
