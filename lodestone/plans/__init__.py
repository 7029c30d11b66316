"""Composite jobs: operators chained into lazy plans."""
