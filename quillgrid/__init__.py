"""Quillgrid: analytics over enterprise-style tables, written as Spark DataFrame jobs."""

__version__ = "0.1.0"
