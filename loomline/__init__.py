"""Spark-native preparation and analysis of text and code corpora."""
