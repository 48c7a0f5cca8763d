"""Relational operators: matching, de-duplication, listing filters, metrics."""
