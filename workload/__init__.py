"""Registered queries: inputs derived from the driver's tables, queries, oracle SQL."""
