"""Sluice: a PySpark-native engine for archives of heterogeneous published records."""
