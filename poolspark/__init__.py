"""Spark-native assignment, calling and decontamination of pooled reads."""
