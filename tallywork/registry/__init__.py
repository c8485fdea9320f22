"""The queries this package answers on the given tables, and the same questions as plain SQL."""
