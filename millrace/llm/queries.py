"""The operators over the given tables, under the names the driver calls."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import (
    collocations, edits, exact, gam, packing, passages, pieces, rules, sharding, simhash, spelling,
    tokenfile, toxicity,
)
from .common import stored, table


def op1_edit_counts(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    # The trees are kept, and the edits work on what was kept.
    trees = stored(edits.built(docs, special=True), "trees")
    return edits.edited(edits.drawn_edits(trees), special=True).select(
        "doc_id", "n_tokens", "edited_tokens", F.size("segment_chars").alias("n_segments"),
        "n_encoded", F.crc32(F.col("text").cast("binary")).alias("text_crc32"),
    )


def op2_packing(spark, sf_dir):
    pieces = packing.tokenized_pieces(table(spark, sf_dir, "documents"), special=True)
    digests = pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packing.packed(digests)


def op3_toxicity(spark, sf_dir):
    return toxicity.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_sharding(spark, sf_dir):
    return sharding.sharded(table(spark, sf_dir, "documents"))


def op5_exact_dedup(spark, sf_dir):
    return exact.deduplicated(table(spark, sf_dir, "documents"))


def op8_simhash(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op6_quality_rules(spark, sf_dir):
    return rules.judged(table(spark, sf_dir, "documents")).drop("quality")


def op7_token_files(spark, sf_dir):
    files = tokenfile.write_tokens(table(spark, sf_dir, "documents"), special=True)
    return tokenfile.read_tokens(spark, files).select(
        "doc_id",
        "start",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )


def op9_sampled_pieces(spark, sf_dir):
    back = pieces.decoded(pieces.sampled(table(spark, sf_dir, "documents")))
    return back.select(
        "doc_id", (F.octet_length("ids") / 4).cast("bigint").alias("n_pieces"),
        F.crc32("ids").alias("ids_crc32"), "text_crc32",
        F.crc32(F.col("decoded").cast("binary")).alias("decoded_crc32"),
    )


def op10_quality_classifier(spark, sf_dir):
    return gam.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_spelling_variants(spark, sf_dir):
    return spelling.variants(table(spark, sf_dir, "documents"))


def op12_substring_dedup(spark, sf_dir):
    return passages.deduplicated(table(spark, sf_dir, "documents"))


def op13_collocations(spark, sf_dir):
    return collocations.collocations(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_edit_counts, op2_packing, op3_toxicity, op4_sharding, op5_exact_dedup,
        op6_quality_rules, op7_token_files, op8_simhash, op9_sampled_pieces,
        op10_quality_classifier, op11_spelling_variants, op12_substring_dedup, op13_collocations,
    )
}

ORACLES = {
    "op5_exact_dedup": """
        SELECT doc_id,
               max(doc_id) OVER same AS keep_id,
               count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept,
               sha256(coalesce(text, '')) AS text_sha256
        FROM documents
        WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
}
