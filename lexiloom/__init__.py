"""Parallel-text production, scoring and curation as Spark jobs."""

__version__ = "0.1.0"
