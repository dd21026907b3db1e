"""The operators, grouped by the table they maintain."""
