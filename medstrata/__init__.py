"""Medallion-style data operators and healthcare analytics on Apache Spark."""

__version__ = "0.1.0"
