"""Operators for large-scale training-data pipelines.

Nothing outside this subpackage imports it; ``queries.QUERIES`` and
``queries.ORACLE_SQL`` are what the repository's entry file registers.
"""
