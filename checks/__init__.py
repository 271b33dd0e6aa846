"""Registered queries, their SQL and the mapping from the test tables."""
