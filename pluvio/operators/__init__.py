"""Reusable DataFrame operators: filters, joins, running totals, profiles."""
