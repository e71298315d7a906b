"""pitchflow: sports-data landing, staging, marts, live events and data quality on Spark."""

__version__ = "0.1.0"
