"""Missiva: a PySpark-native analytics engine for mail archives."""

__version__ = "0.1.0"
