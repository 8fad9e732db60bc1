"""Batch operators, grouped by the table they work on."""
