"""lakeward: contract-driven data products on Spark."""

__version__ = "0.1.0"
