"""Registered queries over the given tables, and the same answers in plain SQL."""
