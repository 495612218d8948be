"""Spark jobs that turn landed user feedback into clean, scored, keyed tables."""

__version__ = "0.1.0"
