"""orderlens: customer analytics over order data, written as Spark DataFrame jobs."""

from orderlens.settings import Settings

__all__ = ["Settings"]
