"""A PySpark-native mutational-profiling analytics engine."""
