"""Registered queries: library operators applied to the provided tables, with oracles."""
