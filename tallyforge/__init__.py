"""Retail analytics on Spark: conformed staging, facts, dimensions, rollups, history and checks."""

from tallyforge.settings import Settings

__all__ = ["Settings"]
