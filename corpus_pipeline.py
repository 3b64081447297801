"""From documents to packed training sequences, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; the next one
gets it as written to Parquet and read again. All but the last give rows of
``documents`` as they came.

Cases: rows that repeat an id are judged like any others, but one text of one id stays once after
the exact stage. The near-duplicate stage keeps one row of each component, one with
its smallest id, or one without an id where the component has no other. An empty table
goes through to an empty result.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.llm import exact, gam, packing, simhash, toxicity
from millrace.llm.common import stored, table


def clean(spark, docs, sf_dir):
    """Documents that the toxicity classifier takes for clean."""
    return toxicity.kept(docs, table(spark, sf_dir, "labels"))


def good(spark, docs, sf_dir):
    """Documents that the quality classifier takes for good."""
    return gam.kept(docs, table(spark, sf_dir, "labels"))


def distinct_texts(spark, docs, sf_dir):
    """One document of each text."""
    return exact.kept(docs)


def distinct_prints(spark, docs, sf_dir):
    """One document of each component of near fingerprints."""
    return simhash.kept(docs)


def sequences(spark, docs, sf_dir):
    """Where every piece of every document lies in the training sequences."""
    pieces = packing.tokenized_pieces(docs, special=True)
    return packing.packed(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))


STAGES = [
    ("toxicity", clean),
    ("quality", good),
    ("exact_dedup", distinct_texts),
    ("near_dedup", distinct_prints),
    ("packing", sequences),
]
# Classifiers, fingerprints over whole texts and token ids have no SQL.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for n, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if n + 1 < len(STAGES):
            docs = stored(docs, "stage")
    return docs
