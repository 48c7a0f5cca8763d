"""Composite jobs (reports, benchmark table, KPIs) and the test-data queries."""
