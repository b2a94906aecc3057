"""Operators for preparing training data at scale, and the registered queries that apply them.

Nothing else in the library imports this package. ``orderlake.llm.queries`` holds QUERIES and ORACLES.
"""
