"""Operators for large text-training-data pipelines; nothing else in the library imports them."""
