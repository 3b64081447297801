"""Costly expressions that are evaluated once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def once(rows: DataFrame, **columns: Column) -> DataFrame:
    """Rows with added (or replaced) columns, each evaluated once.

    Spark puts a column's expression wherever the column is used: into filters
    pushed below the projection and into every branch of later expressions. For
    JSON parsing or a chain of regular expressions over a page that multiplies
    the work. An ``explode`` of a one-element array yields the same rows, and
    the optimizer moves no expression across it. Use it for expressions that
    cost much more than the copy of one struct.
    """
    made = F.explode(F.array(F.struct(*[c.alias(n) for n, c in columns.items()])))
    kept = [c for c in rows.columns if c not in columns]
    return rows.select(*kept, made.alias("made")).select(*kept, "made.*")
