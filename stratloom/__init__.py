"""Spark-native engine that turns page texts of publications into a map-ready table of field sites."""

__version__ = "0.1.0"
