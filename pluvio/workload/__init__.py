"""Queries over the given tables: the observation mapping, registry and SQL."""
