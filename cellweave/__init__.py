"""Spark-native mosaic, temporal-consensus and training-data engine."""
