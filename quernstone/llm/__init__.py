"""Operators for large training-data pipelines. Nothing outside imports them."""
