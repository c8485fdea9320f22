"""Operators for large training-data pipelines, one module each; nothing else in the library imports them."""
