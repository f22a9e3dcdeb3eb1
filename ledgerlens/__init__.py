"""Risk and transaction-monitoring analytics written as Spark DataFrame pipelines."""

__version__ = "0.1.0"
