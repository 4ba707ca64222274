"""Spark-native annotation and analytics for large tables of clinical-style reports."""
