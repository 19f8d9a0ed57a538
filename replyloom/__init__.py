"""Spark operators for preparing, judging and routing classified requests."""

__version__ = "0.1.0"
