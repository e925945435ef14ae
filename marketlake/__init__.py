"""Commerce analytics on Spark: lake jobs, reports, fraud, sessions, stock and recommendations."""

__version__ = "0.1.0"
