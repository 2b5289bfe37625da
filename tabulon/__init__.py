"""Tabulon: a Spark-native engine for layout text, fact tables and training-data pipelines."""
