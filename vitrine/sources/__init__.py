"""Readers and writers: catalog tables, stored pages, sinks and views."""
