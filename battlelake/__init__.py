"""Battle-log analytics and next-card recommendation as Spark DataFrame jobs."""

__version__ = "0.1.0"
