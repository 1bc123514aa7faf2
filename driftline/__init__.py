"""Time-series feature, incremental-load and drift analytics on Spark DataFrames."""

__version__ = "0.1.0"
