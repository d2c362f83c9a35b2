"""Reusable DataFrame transforms: filters, joins, deduplication, merging, quality rules and running totals."""
