"""Queries over the given test tables and the same questions in SQL."""
