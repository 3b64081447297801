"""Exact deduplication by recipes of content-defined chunks.

A text is cut where its content says so: at the first sentence end, line end or
bar after ``LEAST`` characters, at ``MOST`` characters at the latest. Equal
chunks get one identifier, a 64-bit hash that is verified: every distinct chunk
is compared with the others of its hash, and where two differ they are told
apart by a second number. The recipe of a text is the list of its chunks'
identifiers, and texts are equal exactly if their recipes are. Distinct chunks
move once, to be verified; after that only recipes move, not texts.

Everything is built of DataFrame functions.

Cases: a missing text is an empty one, and its recipe is the empty list. Missing
ids form rows like any other; the largest id stays, a missing one only among
missing ones. Of rows with one text and the same largest id exactly one stays. A text that is no valid UTF-8 is
one chunk. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import id_and_text, placed, stored

LEAST, MOST = 512, 8192
# So many clashing hashes or chunks at most are broadcast; 320 MB if all chunks are as long as can be.
FEW = 10_000


def chunks(text, least: int = LEAST, most: int = MOST):
    """Array of the chunks of a text; joined they are the text."""
    # All counted parts are lazy or of fixed length, as the matcher goes through these in a loop.
    pattern = (
        rf"(?s).{{{least},{most - 1}}}?(?:[\n.!?;|]|\z)|.{{{most}}}|.{{1,{least - 1}}}?\z"
    )
    cut = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return F.when(F.is_valid_utf8(text), cut).otherwise(F.array(text))


def chunk_store(docs: DataFrame, least: int = LEAST, most: int = MOST) -> DataFrame:
    """``hash, chunk`` of the distinct chunks, each once."""
    each = id_and_text(docs).select(F.explode(chunks(F.col("text"), least, most)).alias("chunk"))
    return each.select(F.xxhash64("chunk").alias("hash"), "chunk").distinct()


def clashes(store: DataFrame) -> DataFrame | None:
    """``hash, chunk, nth`` of the chunks that share their hash with another; None if none do.

    Hashes alone are counted first, so chunks move again only if some clash.
    """
    twice = stored(
        store.groupBy("hash").agg(F.count("*").alias("n")).filter("n > 1").select("hash"), "twice"
    )
    few = twice.limit(FEW + 1).count()
    if not few:
        return None
    found = store.join(F.broadcast(twice) if few <= FEW else twice, "hash")
    order = Window.partitionBy("hash").orderBy("chunk")
    named = found.select("hash", "chunk", (F.row_number().over(order) - 1).alias("nth"))
    return stored(named, "clashes")


def recipes(docs: DataFrame, least: int = LEAST, most: int = MOST, bits: int = 64) -> DataFrame:
    """Stored ``doc_id, recipe, text_sha256, part, row``.

    ``bits`` below 64 shortens the hash, so that tests can see chunks clash.
    """
    def hashed(c):
        return F.shiftrightunsigned(F.xxhash64(c), 64 - bits)

    rows = id_and_text(docs).withColumn("chunks", chunks(F.col("text"), least, most))
    plain = stored(
        placed(
            rows.select(
                "doc_id",
                F.transform("chunks", hashed).alias("recipe"),
                F.sha2("text", 256).alias("text_sha256"),
            )
        ),
        "recipes",
    )
    store = chunk_store(docs, least, most)
    if bits < 64:
        store = store.withColumn("hash", hashed(F.col("chunk")))
    clashing = clashes(store)
    return stored(_told_apart(rows, clashing, hashed), "recipes") if clashing else plain


def _told_apart(rows: DataFrame, clashing: DataFrame, hashed) -> DataFrame:
    """The recipes with a second list, which tells chunks of one hash apart."""
    each = placed(rows).select(
        "doc_id", F.sha2("text", 256).alias("text_sha256"), "part", "row",
        F.posexplode_outer("chunks").alias("pos", "chunk"),
    )
    if clashing.limit(FEW + 1).count() <= FEW:
        clashing = F.broadcast(clashing)
    named = each.withColumn("hash", hashed(F.col("chunk"))).join(clashing, ["hash", "chunk"], "left")
    item = F.struct("pos", "hash", F.coalesce("nth", F.lit(0)).cast("bigint").alias("nth"))
    whole = named.groupBy("row").agg(
        *[F.first(c).alias(c) for c in ("doc_id", "text_sha256", "part")],
        F.sort_array(F.collect_list(F.when(F.col("pos").isNotNull(), item))).alias("items"),
    )
    recipe = F.concat(
        F.transform("items", lambda i: i["hash"]), F.transform("items", lambda i: i["nth"])
    )
    return whole.select("doc_id", recipe.alias("recipe"), "text_sha256", "part", "row")


def groups(found: DataFrame) -> DataFrame:
    """``recipe, keep_id, keep_row, group_size`` of the recipes that several rows have."""
    return (
        found.groupBy("recipe")
        .agg(
            F.max("doc_id").alias("keep_id"),
            F.coalesce(F.max_by("row", "doc_id"), F.min("row")).alias("keep_row"),
            F.count("*").alias("group_size"),
        )
        .filter("group_size > 1")
    )


def deduplicated(docs: DataFrame) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` for every row."""
    found = recipes(docs)
    shared = F.col("group_size").isNotNull()
    # Stored, so that the join's two sides come from shuffles and a hot recipe is split.
    return found.join(stored(groups(found), "groups"), "recipe", "left").select(
        "doc_id",
        F.when(shared, F.col("keep_id")).otherwise(F.col("doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("bigint").alias("group_size"),
        F.when(shared, F.col("row") == F.col("keep_row")).otherwise(F.lit(True)).alias("kept"),
        "text_sha256",
    )


def kept(docs: DataFrame) -> DataFrame:
    """One row of each text, all columns as they are."""
    verdicts = stored(deduplicated(docs), "verdicts")
    staying = verdicts.filter("kept").select(F.col("doc_id").alias("kept_id"), "text_sha256")
    same_id = F.col("doc_id").eqNullSafe(F.col("kept_id"))
    repeated = verdicts.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1")
    repeated = stored(repeated.select(F.col("doc_id").alias("repeated_id")), "repeated")
    if repeated.isEmpty():
        return docs.join(staying.select("kept_id"), same_id, "left_semi")
    # Where several rows have one id, the id alone does not say which of them stays.
    is_repeated = F.col("doc_id").eqNullSafe(F.col("repeated_id"))
    single = docs.join(repeated, is_repeated, "left_anti")
    unclear = docs.join(repeated, is_repeated, "left_semi")
    digest = F.sha2(F.coalesce("text", F.lit("")), 256)
    of_text = same_id & (digest == F.col("text_sha256"))
    names = docs.columns
    whole = F.struct(*[F.col(f"`{c}`") for c in names]).alias("kept_row")
    once = (
        unclear.join(staying, of_text, "left_semi")
        .select(whole, F.col("doc_id").alias("id"), digest.alias("digest"))
        .dropDuplicates(["id", "digest"])
    )
    return single.join(staying.select("kept_id"), same_id, "left_semi").union(
        once.select(*[F.col(f"kept_row.`{c}`") for c in names])
    )
