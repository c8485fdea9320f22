"""Schemas, CSV input and stored tables."""
