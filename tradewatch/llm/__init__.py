"""Operators of a training-data pipeline (URL filters, near-duplicate joins, quality rules, ...).

Nothing else in the library imports this subpackage; its queries are in ``queries.py``.
"""
