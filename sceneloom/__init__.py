"""Spark-native kernels for ordered media-style event data."""
