"""Spark-native warehouse loading and column-lineage analysis."""
