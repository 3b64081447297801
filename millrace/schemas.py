"""Row types of the records that enter, move through and leave the jobs."""

from pyspark.sql.types import (
    ArrayType,
    LongType,
    StringType,
    StructField,
    StructType,
)


def _struct(*fields):
    return StructType([StructField(name, kind, True) for name, kind in fields])


# A byte range [start, end) of an archive; no end means up to the end of the file.
LOCATION = _struct(("key", StringType()), ("start", LongType()), ("end", LongType()))

# What an archive scan emits before the time stamp is derived from the key.
SCANNED = _struct(
    ("key", StringType()),
    ("start", LongType()),
    ("end", LongType()),
    ("uri", StringType()),
    ("content", StringType()),
    ("error", StringType()),
)

# JSON part of a capture-index line.
CAPTURE = _struct(
    ("url", StringType()),
    ("mime", StringType()),
    ("status", StringType()),
    ("filename", StringType()),
    ("offset", StringType()),
    ("length", StringType()),
)

# Every key a result line may hold. Numbers and times are read as text, as the
# writers differ in the type of ``ts``; readers cast what they need.
RESULT_LINE = _struct(
    ("uri", StringType()),
    ("ts", StringType()),
    ("content", StringType()),
    ("title", StringType()),
    ("text", StringType()),
    ("criticScore", StringType()),
    ("criticNum", StringType()),
    ("audienceScore", StringType()),
    ("audienceNum", StringType()),
    ("error", StringType()),
    ("reason", StringType()),
    ("ts_raw", StringType()),
)

# Cleaned score snapshots. The counts are wider than the declared 16 bits of the
# usual table, as audience counts pass 32,767 and must not be lost.
SCORE = _struct(
    ("ts", LongType()),
    ("name", StringType()),
    ("critic", LongType()),
    ("numCritic", LongType()),
    ("audience", LongType()),
    ("numAudience", LongType()),
)

_OUTPUT = _struct(("value", LongType()), ("addr", StringType()))
_INPUT = StructType([StructField("prev_out", _OUTPUT, True)])
TRANSACTION = _struct(
    ("fee", LongType()), ("inputs", ArrayType(_INPUT)), ("out", ArrayType(_OUTPUT))
)
BLOCK = _struct(("block_index", LongType()), ("tx", ArrayType(TRANSACTION)))
PAYLOAD = StructType([StructField("blocks", ArrayType(BLOCK), True)])
