"""Operators for preparing large text corpora (training data), one module each.

Nothing else in the package imports this subpackage. ``queries.QUERIES`` and
``queries.ORACLE`` hold the registered queries and their SQL.
"""
