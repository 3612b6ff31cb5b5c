"""Spark-native text-corpus analytics."""
