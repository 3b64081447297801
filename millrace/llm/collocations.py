"""Collocations by set-oriented relational mining.

Texts are cut into pieces and words once, into a persisted relation of occurrences, sorted by
piece and position. It is kept in chunks: a chunk has the numbers of its words in that order,
a break between pieces, and a list of what the numbers stand for. One round makes
phrases one word longer:

1. merge join: occurrences of phrases meet, by piece and adjacent position, the occurrences of
   the phrases that begin one word later, as both are sorted the same way;
2. group count: a chunk's distinct phrases, each named by the shorter phrase and its new
   word, are counted over all chunks;
3. semi join: frequent phrases go back to the chunks that have them, and only their
   occurrences are persisted for the next round.

A phrase moves once a chunk however often it occurs there, so a phrase or language that
holds most of the occurrences is at most one row a chunk.

Cases: a missing text has no words, a missing language is ``und``, ids are not looked at; rows that
repeat count again. A text of any length is in one chunk, with its numbers only. An empty table gives an empty
result. Equal scores and counts are in the order of the phrases, so ranks are unique.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import drop_scratch, scratch_path

LONGEST, LEAST_COUNT, TOP = 4, 30, 2000
# A longer phrase with so many percent of the occurrences takes the place of the shorter.
COVERS = 80
# Characters of text in a chunk; rows of a batch; parts of the first step of the ranking.
CHUNK, _BATCH, _PARTS = 12_000_000, 100_000, 32

_BREAKS = b".,;:!?\n\x0b\x0c\r"
_TABLE = bytes.maketrans(_BREAKS, b"." * len(_BREAKS))


def tokens(raw: bytes) -> list[bytes]:
    """Words in lower case, with a ``.`` where a piece ends; no word has one."""
    return raw.lower().translate(_TABLE).replace(b".", b" . ").split()


class _Numbers(dict):
    """Numbers of the words of one language, from a list that all languages share."""

    def __init__(self, lang: str, words: list):
        super().__init__({b".": -1})
        self.lang, self.words = lang, words

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self.words)
        self.words.append((self.lang, word))
        return number


def _packed(numbers: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(numbers.astype("<i4").tobytes())


def _unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), "<i4")


_WORDS = pa.list_(pa.struct([("lang", pa.string()), ("word", pa.string()), ("n", pa.int64())]))
_CHUNKS = pa.schema([("chunk", pa.int64()), ("places", pa.binary()), ("words", _WORDS)])


def _relate(size: int):
    def relate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, nth = TaskContext.get().partitionId(), 0
        words: list = []
        of_lang: dict[str, _Numbers] = {}
        held, chars = [], 0

        def chunk():
            places = np.concatenate(held)
            n = np.bincount(places[places >= 0], minlength=len(words)).tolist()
            listed = [(g, w.decode("utf-8", "replace"), m) for (g, w), m in zip(words, n)]
            fields = [pa.array(c, t.type) for c, t in zip(zip(*listed), _WORDS.value_type)]
            rows = pa.StructArray.from_arrays(fields, fields=list(_WORDS.value_type))
            lists = pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), rows)
            number = pa.array([(part << 16) + nth], pa.int64())
            return pa.RecordBatch.from_arrays(
                [number, pa.array([_packed(places)], pa.binary()), lists.cast(_WORDS)], schema=_CHUNKS
            )

        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
                numbers = of_lang.get(lang)
                if numbers is None:
                    numbers = of_lang[lang] = _Numbers(lang, words)
                found = tokens(text.as_py())
                held.append(np.fromiter(map(numbers.__getitem__, found), np.int32, len(found)))
                held.append(np.array([-1], np.int32))
                chars += len(found) * 6
                if chars >= size and words:
                    yield chunk()
                    words, of_lang, held, chars, nth = [], {}, [], 0, nth + 1
        if words:
            yield chunk()

    return relate


def occurrences(docs: DataFrame, size: int = CHUNK) -> DataFrame:
    """The relation of all occurrences: ``chunk, places, words``. Store it, as it numbers what it meets."""
    rows = docs.select(
        F.coalesce("lang", F.lit("und")).alias("lang"),
        F.coalesce("text", F.lit("")).cast("binary").alias("text"),
    )
    schema = "chunk bigint, places binary, words array<struct<lang:string,word:string,n:bigint>>"
    return rows.mapInArrow(_relate(size), schema)


def _joined(phrases: np.ndarray, words: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, int]:
    """The merge join: places of phrases of ``size`` words that go on by a word, and a number for
    each result, ``phrase * words + word``.

    Both arrays are by place, with -1 where there is nothing frequent.
    """
    n = max(len(phrases) - size, 0)
    here = np.flatnonzero((phrases[:n] >= 0) & (phrases[1 : n + 1] >= 0) & (words[size : size + n] >= 0))
    many = int(words.max(initial=0)) + 1
    return here, phrases[here].astype(np.int64) * many + words[here + size], many


_CANDIDATES = pa.schema(
    [("chunk", pa.int64()), ("no", pa.int32()), ("first", pa.int64()), ("last", pa.int64()), ("n", pa.int32())]
)


def _rows(batches):
    """One row of a batch at a time, as it may be large; lists as arrays, packed numbers unpacked."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = {}
            for name, column in zip(batch.schema.names, batch.columns):
                value = column[i]
                if not value.is_valid:
                    row[name] = None
                elif pa.types.is_list(column.type) or pa.types.is_large_list(column.type):
                    row[name] = value.values
                elif pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type):
                    row[name] = _unpacked(value.as_py())
                else:
                    row[name] = value.as_py()
            yield row


def _phrases_are_words(row: dict) -> dict:
    """The first relation has no phrases of its own: they are its words."""
    if row["phrases_at"] is None:
        row |= {"phrase_ids": row["word_ids"], "phrases_at": row["words_at"]}
    return row


def _extend(size: int):
    def extend(batches):
        for row in map(_phrases_are_words, _rows(batches)):
            _, both, many = _joined(row["phrases_at"], row["words_at"], size)
            both, times = np.unique(both, return_counts=True)
            first, last = row["phrase_ids"].to_numpy(), row["word_ids"].to_numpy()
            for at in range(0, len(both), _BATCH):
                part = both[at : at + _BATCH]
                columns = (
                    np.full(len(part), row["chunk"]), np.arange(at, at + len(part)), first[part // many],
                    last[part % many], times[at : at + _BATCH],
                )
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c.astype(t.type.to_pandas_dtype())) for c, t in zip(columns, _CANDIDATES)],
                    schema=_CANDIDATES,
                )

    return extend


_RELATION = pa.schema(
    [
        ("chunk", pa.int64()), ("word_ids", pa.list_(pa.int64())), ("words_at", pa.binary()),
        ("phrase_ids", pa.list_(pa.int64())), ("phrases_at", pa.binary()),
    ]
)
_RELATION_SQL = "chunk bigint, word_ids array<bigint>, words_at binary, phrase_ids array<bigint>, phrases_at binary"


def _semi_joined(numbers: np.ndarray, ids: pa.Array | None) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the frequent ones, and their new numbers at every place; -1 where there is none.

    ``ids`` has ``no, id`` of the numbers that are frequent.
    """
    if ids is None or not len(ids):
        return np.zeros(0, np.int64), np.full(len(numbers), -1, np.int32)
    old, id_ = ids.field("no").to_numpy(), ids.field("id").to_numpy()
    # The last entry is for places without a number.
    table = np.full(max(int(numbers.max(initial=0)), int(old.max())) + 2, -1, np.int32)
    table[old] = np.arange(len(old))
    return id_, table[numbers]


def _relation(chunk: int, word_ids, words_at, phrase_ids, phrases_at) -> pa.RecordBatch:
    packed = None if phrases_at is None else _packed(phrases_at)
    values = chunk, word_ids, _packed(words_at), phrase_ids, packed
    arrays = [
        pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), pa.array(v, pa.int64()))
        if pa.types.is_list(f.type) and v is not None else pa.array([v], f.type)
        for v, f in zip(values, _RELATION)
    ]
    return pa.RecordBatch.from_arrays([a.cast(f.type) for a, f in zip(arrays, _RELATION)], schema=_RELATION)


def _ids(found: pa.Table) -> pa.Array | None:
    """``no, id`` of the numbers of a chunk that are frequent."""
    return found.select(["no", "id"]).combine_chunks().to_struct_array().combine_chunks() if found.num_rows else None


def _first_relation(chunk: pa.Table, found: pa.Table) -> pa.Table:
    (row,) = _rows(chunk.to_batches())
    ids, at = _semi_joined(row["places"], _ids(found))
    return pa.Table.from_batches([_relation(row["chunk"], ids, at, None, None)])


def _next_relation(size: int):
    def following(chunk: pa.Table, found: pa.Table) -> pa.Table:
        row = _phrases_are_words(next(_rows(chunk.to_batches())))
        here, both, _ = _joined(row["phrases_at"], row["words_at"], size)
        ids, numbers = _semi_joined(np.unique(both, return_inverse=True)[1], _ids(found))
        at = np.full(len(row["phrases_at"]), -1, np.int32)
        at[here] = numbers
        return pa.Table.from_batches([_relation(row["chunk"], row["word_ids"], row["words_at"], ids, at)])

    return following


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class _Steps:
    """Stored tables of one run; those that no later step reads are dropped."""

    def __init__(self, spark):
        self.spark, self.root = spark, scratch_path(spark, "collocations")

    def store(self, name: str, rows: DataFrame) -> DataFrame:
        # Shuffle files of a step go when it is written, not when the driver's JVM next collects garbage.
        before = self.spark.conf.get(_CLEANUP)
        self.spark.conf.set(_CLEANUP, "true")
        try:
            rows.write.parquet(f"{self.root}/{name}")
        finally:
            self.spark.conf.set(_CLEANUP, before)
        return self.spark.read.schema(rows.schema).parquet(f"{self.root}/{name}")

    def drop(self, *names: str) -> None:
        for name in names:
            drop_scratch(self.spark, f"{self.root}/{name}")


def _frequent(steps: _Steps, k: int, rows: DataFrame, key: list[str], least: int) -> tuple[DataFrame, DataFrame]:
    """The group count: stored ``chunk, no, id`` of the chunks' frequent keys, and the keys with ``id, a``.

    A key has a row a chunk, so it is summed up where the rows of the key meet anyway; the first of these
    rows gives it its number and alone holds the key, so the keys need no further shuffle.
    """
    same = Window.partitionBy(*key)
    own = F.col("chunk") * F.lit(1 << 28) + F.col("no")
    kept = rows.withColumn("a", F.sum("n").over(same)).withColumn("id", F.min(own).over(same))
    of_key = [F.when(F.col("id") == own, F.col(c)).alias(c) for c in (*key, "a")]
    kept = kept.filter(F.col("a") >= least).select("chunk", "no", "id", *of_key)
    kept = steps.store(f"frequent-{k}", kept)
    return kept, steps.store(f"groups-{k}", kept.filter(F.col("id") == own).select(*key, "a", "id"))


def _returned(relation: DataFrame, kept: DataFrame, semi_join) -> DataFrame:
    """The semi join: every chunk of the relation meets its frequent numbers, at most as many as it has words.

    Both sides get as many partitions as there are chunks, so that few of these large rows meet in a task;
    the numbers come as rows in small batches and are never an array in a row.
    """
    tasks = max(1, relation.count())
    chunks = relation.repartition(tasks, "chunk").groupBy("chunk")
    numbers = kept.select("chunk", "no", "id").repartition(tasks, "chunk").groupBy("chunk")
    return chunks.cogroup(numbers).applyInArrow(semi_join, _RELATION_SQL)


def frequent_phrases(docs: DataFrame, least: int = LEAST_COUNT, longest: int = LONGEST, size: int = CHUNK):
    """``(phrases, totals)``: stored ``lang, phrase, size, a`` of all frequent phrases, single
    words among them, and ``lang, n``."""
    steps = _Steps(docs.sparkSession)
    every = steps.store("occurrences", occurrences(docs, size))
    local = every.select("chunk", F.posexplode("words").alias("no", "w")).select("chunk", "no", "w.*")
    totals = steps.store("totals", local.groupBy("lang").agg(F.sum("n").alias("n")))
    kept, groups = _frequent(steps, 1, local, ["lang", "word"], least)
    relation = steps.store("relation-1", _returned(every.select("chunk", "places"), kept, _first_relation))
    steps.drop("occurrences", "frequent-1")
    words = groups.select("id", "lang", F.col("word").alias("phrase"), F.lit(1).alias("size"), "a")
    found, phrases = words, words
    for k in range(1, longest):
        candidates = relation.mapInArrow(_extend(k), "chunk bigint, no int, first bigint, last bigint, n int")
        kept, groups = _frequent(steps, k + 1, candidates, ["first", "last"], least)
        named = phrases.select(F.col("id").alias("first"), "lang", F.col("phrase").alias("head"))
        tail = words.select(F.col("id").alias("last"), F.col("phrase").alias("tail"))
        phrases = steps.store(
            f"phrases-{k + 1}",
            groups.join(named, "first").join(tail, "last").select(
                "id", "lang", F.concat_ws(" ", "head", "tail").alias("phrase"), F.lit(k + 1).alias("size"), "a"
            ),
        )
        found = found.unionByName(phrases)
        if k + 1 < longest:
            relation = steps.store(f"relation-{k + 1}", _returned(relation, kept, _next_relation(k)))
        steps.drop(f"relation-{k}", f"frequent-{k + 1}")
    return found.drop("id"), totals


def scored(phrases: DataFrame, totals: DataFrame, covers: int = COVERS) -> DataFrame:
    """``lang, phrase, a, l, r, n, score`` of the phrases that no longer one stands for."""
    longer = phrases.filter("size > 1").withColumn("words", F.split("phrase", " "))
    cuts = longer.withColumn("k", F.explode(F.expr("sequence(1, size - 1)"))).select(
        "lang", "phrase", "a", "k",
        F.array_join(F.slice("words", F.lit(1), F.col("k")), " ").alias("first"),
        F.array_join(F.slice("words", F.col("k") + 1, F.col("size") - F.col("k")), " ").alias("rest"),
    )
    count = phrases.select("lang", F.col("phrase").alias("part"), F.col("a").alias("count"))
    halves = cuts.join(count.toDF("lang", "first", "l"), ["lang", "first"]).join(
        count.toDF("lang", "rest", "r"), ["lang", "rest"]
    )
    # Decimals, as products may pass 64 bits.
    score = F.expr("(2000000 * cast(a as decimal(19, 0))) div (cast(l as decimal(19, 0)) + r)")
    best = halves.withColumn("score", score).groupBy("lang", "phrase", "a").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("best")
    )
    # Shorter phrases inside a longer one, by where they start and how many words they have.
    inside = longer.filter("size > 2").select(
        "lang", F.col("a").alias("around"), "words", "size",
        F.explode(F.expr("sequence(2, size - 1)")).alias("m"),
    )
    inside = inside.withColumn("at", F.explode(F.expr("sequence(1, size - m + 1)"))).select(
        "lang", F.array_join(F.slice("words", F.col("at"), F.col("m")), " ").alias("phrase"), "around"
    )
    around = inside.groupBy("lang", "phrase").agg(F.max("around").alias("around"))
    covered = F.expr(f"100 * cast(around as decimal(19, 0)) >= {covers} * cast(a as decimal(19, 0))")
    return (
        best.join(around, ["lang", "phrase"], "left")
        .filter(~F.coalesce(covered, F.lit(False)))
        .join(totals, "lang")
        .select("lang", "phrase", "a", "best.l", "best.r", "n", F.col("best.score").cast("bigint").alias("score"))
    )


def collocations(
    docs: DataFrame, least: int = LEAST_COUNT, longest: int = LONGEST, top: int = TOP, size: int = CHUNK
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``top`` phrases of every language."""
    rows = scored(*frequent_phrases(docs, least, longest, size))
    order = [F.desc("score"), F.desc("a"), "phrase"]
    # A language may hold most phrases: the first of its parts are found side by side.
    part = F.pmod(F.xxhash64("phrase"), F.lit(_PARTS))
    firsts = rows.withColumn("part", part).withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))
    )
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint")
    return firsts.filter(F.col("rank") <= top).withColumn("rank", rank).filter(F.col("rank") <= top).select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score"
    )
