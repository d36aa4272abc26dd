"""Hourly grid observations on Spark: ingest, marts, checks, scoring and read queries."""

from wattlane.lake import Lake
from wattlane.session import prepare
from wattlane.window import BatchWindow

__all__ = ["BatchWindow", "Lake", "prepare"]
