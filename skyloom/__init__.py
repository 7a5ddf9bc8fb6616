"""Spark-native analytics for geospatial telemetry, point clouds and quality assurance."""

__version__ = "0.1.0"
