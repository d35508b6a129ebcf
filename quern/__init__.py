"""Quern: a PySpark-native engine for web-corpus extraction, cleaning and de-duplication."""

__version__ = "0.1.0"
