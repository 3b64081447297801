"""Good rows and failed rows of one job."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def good(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("error").isNull())


def failed(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("error").isNotNull())
