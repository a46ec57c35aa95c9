"""Spark-native building blocks for spectro-polarimetric survey catalogues."""

__version__ = "0.1.0"
