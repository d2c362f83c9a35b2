"""Archived HTML to rows: one small Arrow kernel lists the elements of a page, everything else is column expressions."""
