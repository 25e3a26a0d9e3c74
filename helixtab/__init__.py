"""Spark-native building, enrichment, auditing and analysis of wide annotation tables."""

__version__ = "0.1.0"
