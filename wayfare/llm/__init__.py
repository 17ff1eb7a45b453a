"""Operators of a training-data pipeline, their queries and checking SQL.

Nothing outside this package imports it.
"""
