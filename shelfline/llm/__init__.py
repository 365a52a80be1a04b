"""Operators for pipelines of training text; nothing outside this package imports it."""
