"""Column expressions for URLs, index fields, scores and times."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import formats as fmt


def none_if_empty(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def host_of(uri: Column) -> Column:
    """Host part as written (port, case and query kept); NULL if there is none."""
    return none_if_empty(F.regexp_extract(uri, fmt.HOST, 1))


def movie_slug(uri: Column) -> Column:
    """Name of a movie page: the path part after ``/m/``, without a query string."""
    return F.substring_index(F.regexp_replace(uri, fmt.MOVIE_PAGE, "$2"), "?", 1)


def archive_time(key: Column) -> Column:
    """Crawl time told by an archive's name; the epoch if it tells none."""
    stamp = F.try_to_timestamp(
        F.regexp_extract(key, fmt.ARCHIVE_STAMP, 1), F.lit(fmt.ARCHIVE_STAMP_FORMAT)
    )
    millis = F.regexp_extract(key, fmt.ARCHIVE_EPOCH_MS, 1).try_cast("bigint")
    return F.coalesce(
        stamp,
        F.timestamp_seconds(F.floor(millis / 1000)),
        F.timestamp_seconds(F.lit(0)),
    )


def readable_time(epoch_seconds: Column) -> Column:
    return F.date_format(F.timestamp_seconds(epoch_seconds), fmt.TIME_FORMAT)


def record_time(raw: Column) -> Column:
    """Time of a record whose source writes epoch seconds, a date of digits, or a date text."""
    day = F.when(raw.rlike(r"^[12][0-9]{3}[01][0-9][0-3][0-9]$"), F.try_to_timestamp(raw, F.lit("yyyyMMdd")))
    moment = F.when(raw.rlike(r"^[12][0-9]{13}$"), F.try_to_timestamp(raw, F.lit("yyyyMMddHHmmss")))
    seconds = F.timestamp_seconds(raw.try_cast("double"))
    return F.coalesce(day, moment, seconds, raw.try_cast("timestamp"))


def percent_digits(score: Column) -> Column:
    """The number in a score such as ``85%``; NULL unless it is digits only."""
    bare = F.replace(score, F.lit("%"), F.lit(""))
    return F.when(bare.rlike("^[0-9]+$"), bare.try_cast("bigint"))


def first_token(c: Column) -> Column:
    """Trim, take newlines out (not replaced by blanks), keep text up to a blank."""
    tidy = F.replace(trim_space(c), F.lit("\n"), F.lit(""))
    return F.substring_index(tidy, " ", 1)


def trim_space(c: Column) -> Column:
    return F.regexp_replace(c, r"^[ \t\n\r]+|[ \t\n\r]+$", "")


def range_end(start: Column, length: Column) -> Column:
    return start + length
