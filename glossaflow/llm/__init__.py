"""Operators for large-scale training-data preparation.

Every operator takes and returns DataFrames. Nothing outside this subpackage
imports it; ``queries.py`` holds the registered queries and ``oracles.py``
their SQL.
"""
