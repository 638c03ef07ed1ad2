"""Medallion event analytics for food delivery, ads and orders, as Spark DataFrame operators and streams."""

__version__ = "0.1.0"
