"""Operators of a training-data pipeline, as Spark jobs.

Nothing outside this subpackage imports it. Each module holds one operator with
its own interface; ``queries`` applies the operators to the given tables.
"""
