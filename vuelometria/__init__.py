"""Flight-operations analytics on Spark: feeds, daily indicators, star schema, dashboard queries."""

__version__ = "0.1.0"
