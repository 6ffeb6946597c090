"""Data-quality measuring and guarding for Spark tables."""

__version__ = "0.1.0"
