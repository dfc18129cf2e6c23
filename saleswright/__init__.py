"""Sales analytics on Spark: clean, measure, report and forecast order lines."""

__version__ = "0.1.0"
