"""Bindings to concrete tables, the registered queries and their SQL checks."""
