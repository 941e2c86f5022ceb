"""Strandline: vector-feature lakehouse jobs written with the PySpark DataFrame API."""

__version__ = "0.1.0"
