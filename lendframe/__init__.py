"""Spark-native data work behind lending-risk models."""
