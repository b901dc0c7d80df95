"""Operators for preparing training text at scale: one module per operator.

Nothing outside this folder imports it; `queries.py` registers the queries.
"""
