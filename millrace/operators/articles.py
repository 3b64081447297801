"""Record transformations: copy, language, articles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import formats as fmt
from ..functions import html
from ..functions.once import once


def earlier_error(records: DataFrame) -> Column:
    """Error a record already brings from its source, if sources report any."""
    return F.col("error") if "error" in records.columns else F.lit(None).cast("string")


def copy(records: DataFrame) -> DataFrame:
    """The record as it is; the time as the source wrote it and an error stay if there are any."""
    more = [c for c in ("ts_raw", "error") if c in records.columns]
    return records.select("uri", "ts", "content", *more)


def with_language(records: DataFrame) -> DataFrame:
    return once(records, lang=html.language(F.col("content")))


def in_language(records: DataFrame, lang: str = fmt.ARTICLE_LANGUAGE) -> DataFrame:
    return with_language(records).filter(F.col("lang") == lang)


def articles(records: DataFrame, lang: str = fmt.ARTICLE_LANGUAGE) -> DataFrame:
    """``uri, ts, title, text, error``: one row per page of the language.

    Pages of other languages are dropped; a page without article and body keeps
    its row, with ``error`` set.
    """
    earlier = earlier_error(records)
    # The language is tested on the raw page, before the costlier replacements.
    english = (
        with_language(records.withColumn("error", earlier))
        .filter((F.col("lang") == lang) | F.col("error").isNotNull())
        .select("uri", "ts", "error", "content")
    )
    visible = once(english, content=html.without_hidden(F.col("content")))
    page = F.col("content")
    parsed = once(visible, title=html.title(page), text=html.body_text(page))
    unparsed = F.when(F.col("text").isNull(), "Error processing record: Could not parse")
    return parsed.select("uri", "ts", "title", "text", F.coalesce("error", unparsed).alias("error"))
