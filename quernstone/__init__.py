"""Quernstone: a PySpark-native engine for messy, multi-source incident records."""

__version__ = "0.1.0"
