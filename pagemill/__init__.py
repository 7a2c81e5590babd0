"""Spark-native document analytics: OCR exports to searchable, quality-checked chunks."""

__version__ = "0.1.0"
