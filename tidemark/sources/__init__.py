"""Readers for tables, queries and filtered tables."""
