"""Job-posting catalogue and ingestion on Spark DataFrames."""

__version__ = "0.1.0"
