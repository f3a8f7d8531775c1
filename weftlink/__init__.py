"""weftlink: a PySpark-native engine for building, auditing and evaluating labelled person-matching data."""

__version__ = "0.1.0"
