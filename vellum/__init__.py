"""Spark-native document curation."""
