"""Spark-native analytics for image-stream source catalogues."""

__version__ = "0.1.0"
