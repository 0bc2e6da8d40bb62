"""Spark-first analytics over semi-structured records: sets of (name, value) properties."""

__version__ = "0.1.0"
