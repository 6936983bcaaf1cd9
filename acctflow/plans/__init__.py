"""Composite jobs, the registered queries and their oracle SQL."""
