"""Tick-data analytics on Spark: bars, order flow, profiles and data quality."""

__version__ = "0.1.0"
