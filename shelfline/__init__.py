"""Stockout-aware retail analytics as plain Spark DataFrame functions."""
