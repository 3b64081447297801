"""Spelling variants: words one edit apart, found by dynamic programming over sorted lists.

The vocabulary is dealt into blocks of words that share what one edit leaves alone. Two
words one edit apart, the shorter of ``s`` code points, have a common prefix of ``p`` and a
common suffix of ``s - 1 - p`` code points or more. With ``p`` in ``[lo, hi)`` they share
the first ``lo`` and the last ``s - hi`` code points, and those make the block. Two
intervals, the halves of a word, cover all ``p``; a block of more than ``MOST`` words is
dealt again by the halves of its interval, until it is small or one place wide, when few
words fit it. A pair counts only in the block of its own ``s`` and ``p``, so it is found once.

Within a block the words are sorted. Adjacent words share the rows of the edit matrix over
their common prefix, so rows are kept per range of words with one prefix, and two ranges
are compared by the three cells of the band. Ranges whose band is above one edit are
skipped whole. This goes on for all blocks of a batch side by side.

Cases: a missing text has no words. A missing id enters the hash as an empty text. Rows that
repeat an id count like any others. A run of any length is one word. An empty table gives
an empty result. Of forms with equal counts the smallest in code-point order is taken.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

# Fixed values of the words.
RUN = "[A-Za-zÀ-ÿ]"
LEAST_LENGTH, LEAST_COUNT, SLIPS, OUTWEIGHS = 7, 2, 31, 10
# Words in a block; words scanned side by side; depth from which pairs are compared one by one.
MOST, BATCH, DEEP = 20_000, 40_000, 256
_HELD = 200_000
_LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def spelled(doc_id, run: str) -> str:
    """The run in lower case, one code point short where its hash says so."""
    run = run.translate(_LOWER)
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
    if h % SLIPS:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def _count_words(batches):
    # Shorter runs cannot give a word of the least length.
    runs = re.compile(f"{RUN}{{{LEAST_LENGTH},}}")
    held: Counter = Counter()

    def rows():
        words = [w for w in held if len(w) >= LEAST_LENGTH]
        counts = [held[w] for w in words]
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(counts, pa.int64())], ["word", "n"])

    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
            # One text at a time becomes a Python string.
            for run, n in Counter(runs.findall(text.as_py() or "")).items():
                held[spelled(doc_id, run)] += n
            if len(held) >= _HELD:
                yield rows()
    yield rows()


def vocabulary(docs: DataFrame) -> DataFrame:
    """Stored ``word, n`` of the words that are long and frequent enough."""
    counted = docs.select("doc_id", "text").mapInArrow(_count_words, "word string, n bigint")
    total = counted.groupBy("word").agg(F.sum("n").alias("n"))
    return stored(total.filter(F.col("n") >= LEAST_COUNT), "vocabulary")


def _keyed(rows: DataFrame) -> DataFrame:
    """Adds ``key``, by what the words of an interval share."""
    prefix = F.expr("left(word, lo)")
    suffix = F.expr("right(word, greatest(s - hi, 0))")
    return rows.withColumn("key", F.xxhash64("s", "lo", "hi", prefix, suffix))


def blocks(words: DataFrame, most: int = MOST) -> DataFrame:
    """``word, n, s, lo, hi, key``: each word in every block where it may meet another."""
    length = F.length("word")
    each = words.select("word", "n", F.explode(F.array(length - 1, length)).alias("s"))
    half = F.floor(F.col("s") / 2).cast("int")
    intervals = F.array(
        F.struct(F.lit(0).alias("lo"), half.alias("hi")),
        F.struct(half.alias("lo"), (F.col("s") + 1).alias("hi")),
    )
    open_rows = _keyed(
        each.filter("s > 0").select("word", "n", "s", F.explode(intervals).alias("i"))
        .select("word", "n", "s", "i.lo", "i.hi")
    )
    block, done = ["key", "s", "lo", "hi"], None
    while True:
        sizes = open_rows.groupBy(*block).agg(F.count("*").alias("size"))
        heavy = stored(sizes.filter((F.col("size") > most) & (F.col("hi") - F.col("lo") > 1)).drop("size"), "heavy")
        if heavy.isEmpty():
            return open_rows if done is None else done.unionByName(open_rows)
        light = open_rows.join(heavy, block, "left_anti").select("word", "n", "s", "lo", "hi", "key")
        done = light if done is None else done.unionByName(light)
        middle = F.floor((F.col("lo") + F.col("hi")) / 2).cast("int")
        parts = F.array(
            F.struct(F.col("lo").alias("lo"), middle.alias("hi")),
            F.struct(middle.alias("lo"), F.col("hi").alias("hi")),
        )
        split = open_rows.join(heavy, block, "left_semi").select("word", "n", "s", F.explode(parts).alias("i"))
        open_rows = stored(_keyed(split.select("word", "n", "s", "i.lo", "i.hi")), "dealt")


class _Sorted:
    """Code points of the sorted words of some blocks."""

    def __init__(self, words: list[str], block: np.ndarray):
        self.words = words
        self.codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        self.length = np.fromiter(map(len, words), np.int64, len(words))
        self.start = np.cumsum(self.length) - self.length
        # The blocks' first words have no word before them to share a prefix with.
        self.shared = np.full(len(words), -1, np.int64)
        same = np.flatnonzero(block[1:] == block[:-1]) + 1
        self.shared[same] = self.common(same - 1, same)

    def at(self, word: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """Code points at ``depth`` (from 0); 0 before a word and after it."""
        inside = (depth >= 0) & (depth < self.length[word])
        place = np.where(inside, self.start[word] + depth, 0)
        return np.where(inside, self.codes[place], 0)

    def common(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Lengths of the common prefixes of pairs of words."""
        found = np.zeros(len(left), np.int64)
        going = np.arange(len(left))
        least = np.minimum(self.length[left], self.length[right])
        for depth in range(DEEP):
            going = going[least[going] > depth]
            if not len(going):
                return found
            i, j = left[going], right[going]
            going = going[self.codes[self.start[i] + depth] == self.codes[self.start[j] + depth]]
            found[going] = depth + 1
        for at in going:
            u, v = self.word(left[at]), self.word(right[at])
            other = np.flatnonzero(u[: least[at]] != v[: least[at]])
            found[at] = other[0] if len(other) else least[at]
        return found

    def word(self, i: int) -> np.ndarray:
        return self.codes[self.start[i] : self.start[i] + self.length[i]]

    def one_edit(self, i: int, j: int) -> bool:
        u, v = self.word(i), self.word(j)
        if len(u) > len(v):
            u, v = v, u
        if len(v) - len(u) > 1:
            return False
        other = np.flatnonzero(u != v[: len(u)])
        p = other[0] if len(other) else len(u)
        rest = u[p + 1 :] if len(u) == len(v) else u[p:]
        return bool(np.array_equal(rest, v[p + 1 :]))


def _product(left_from, left_many, right_from, right_many):
    """Every pair of a left and a right number, of many ranges at once: owner, left, right."""
    many = left_many * right_many
    owner = np.repeat(np.arange(len(many)), many)
    nth = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
    wide = right_many[owner]
    return owner, left_from[owner] + nth // wide, right_from[owner] + nth % wide


def near_pairs(words: list[str], block: np.ndarray) -> tuple[_Sorted, np.ndarray, np.ndarray]:
    """Pairs of places of words that are one edit apart and in one block.

    ``words`` are sorted within each block and distinct there.
    """
    s = _Sorted(words, block)
    # What all words of a block share is one row for all of them.
    first = np.flatnonzero(s.shared < 0)
    base = np.minimum.reduceat(np.where(s.shared < 0, s.length, s.shared), first)
    of_block = np.cumsum(s.shared < 0) - 1
    relative = s.shared - base[of_block]
    ends = np.append(first[1:], len(words))
    many = ends - first
    blocks_here = np.flatnonzero(many > 1)
    # Ranges of words with one prefix, by their first words; both sides, and the band's cells:
    # of equally long prefixes, of the left one longer by one, of the right one.
    x = y = blocks_here
    here = np.where(base[blocks_here] > 0, 1, 2).astype(np.int8)
    c, m, p = np.zeros(len(x), np.int8), here, here.copy()
    starts, stops = first, ends
    found_i, found_j = [], []
    for step in range(DEEP):
        if not len(x):
            break
        # The ranges one code point deeper.
        cut = (s.shared < 0) | (relative <= step)
        next_starts = np.flatnonzero(cut)
        next_stops = np.append(next_starts[1:], len(words))
        number = np.cumsum(cut) - 1
        x_from, y_from = number[starts[x]], number[starts[y]]
        x_many = number[stops[x] - 1] + 1 - x_from
        y_many = number[stops[y] - 1] + 1 - y_from
        owner, nx, ny = _product(x_from, x_many, y_from, y_many)
        keep = nx <= ny
        owner, nx, ny = owner[keep], nx[keep], ny[keep]
        u, v = next_starts[nx], next_starts[ny]
        depth = base[of_block[u]] + step
        u1, v1, u0, v0 = s.at(u, depth), s.at(v, depth), s.at(u, depth - 1), s.at(v, depth - 1)
        c0, m0, p0 = c[owner], m[owner], p[owner]
        m1 = np.minimum(m0 + (u1 != v0), c0 + 1)
        p1 = np.minimum(p0 + (u0 != v1), c0 + 1)
        c1 = np.minimum(c0 + (u1 != v1), np.minimum(m1, p1) + 1)
        single = (next_stops[nx] - next_starts[nx] == 1) & (next_stops[ny] - next_starts[ny] == 1)
        alive = (np.minimum(c1, np.minimum(m1, p1)) <= 1) & ~((nx == ny) & single)
        # Both words are over: the cell of their two lengths is their distance.
        a, b = s.length[u], s.length[v]
        over = alive & single & (depth + 1 >= np.maximum(a, b))
        cell = np.where(a == b, c1, np.where(b == a + 1, p1, np.where(a == b + 1, m1, 2)))
        hit = over & (cell == 1)
        found_i.append(u[hit])
        found_j.append(v[hit])
        alive &= ~over
        x, y = nx[alive], ny[alive]
        c, m, p = (np.minimum(k, 2)[alive].astype(np.int8) for k in (c1, m1, p1))
        starts, stops = next_starts, next_stops
    else:
        # Very long words: pairs that are still possible are compared one by one.
        for left, right in zip(x, y):
            pairs = [
                (i, j)
                for i in range(starts[left], stops[left])
                for j in range(max(i + 1, starts[right]), stops[right])
                if s.one_edit(i, j)
            ]
            found_i.append(np.array([i for i, _ in pairs], np.int64))
            found_j.append(np.array([j for _, j in pairs], np.int64))
    nothing = [np.zeros(0, np.int64)]
    return s, np.concatenate(found_i or nothing), np.concatenate(found_j or nothing)


_PAIRS = pa.schema([("word", pa.string()), ("near", pa.string()), ("near_n", pa.int64())])


def _found(rows: pa.Table) -> pa.RecordBatch:
    """Both directions of the pairs within whole blocks."""
    words = rows.column("word").to_pylist()
    n, size, lo, hi, key = (rows.column(c).to_numpy() for c in ("n", "s", "lo", "hi", "key"))
    new = np.ones(len(words), bool)
    new[1:] = False
    for c in (key, size, lo, hi):
        new[1:] |= c[1:] != c[:-1]
    s, i, j = near_pairs(words, np.cumsum(new))
    # A pair belongs to the block of its shorter length and its own common prefix.
    common = s.common(i, j)
    own = (np.minimum(s.length[i], s.length[j]) == size[i]) & (common >= lo[i]) & (common < hi[i])
    i, j = i[own], j[own]
    both, other = np.concatenate([i, j]), np.concatenate([j, i])
    names = np.array(words, dtype=object)
    return pa.RecordBatch.from_arrays(
        [pa.array(names[both], pa.string()), pa.array(names[other], pa.string()), pa.array(n[other], pa.int64())],
        schema=_PAIRS,
    )


def _scan(batches):
    """Blocks come sorted; the last one of a batch may go on in the next."""
    held: pa.Table | None = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        held = rows if held is None else pa.concat_tables([held, rows])
        if held.num_rows < BATCH:
            continue
        key = held.column("key").to_numpy()
        last = len(key) - int(np.argmax(key[::-1] != key[-1])) if key[0] != key[-1] else 0
        if last:
            yield _found(held.slice(0, last).combine_chunks())
            held = held.slice(last)
    if held is not None and held.num_rows:
        yield _found(held.combine_chunks())


def near_words(words: DataFrame, most: int = MOST) -> DataFrame:
    """``word, near, near_n`` for every ordered pair of words one edit apart."""
    dealt = blocks(words, most).repartition("key").sortWithinPartitions("key", "s", "lo", "hi", "word")
    return dealt.mapInArrow(_scan, "word string, near string, near_n bigint")


def variants(docs: DataFrame, most: int = MOST) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every word of the vocabulary."""
    words = vocabulary(docs)
    # The largest count, of equal ones the smallest word.
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near")))
    around = near_words(words, most).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    heavier = -F.col("best.less") >= OUTWEIGHS * F.col("n")
    found = stored(
        words.join(around, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
            F.when(heavier, F.col("best.near")).alias("form"),
            F.when(heavier, -F.col("best.less")).alias("form_n"),
        ),
        "forms",
    )
    # Counts grow tenfold with each form, so chains are short; every round doubles the step.
    steps = found.filter("form is not null").select("word", F.col("form").alias("root"))
    while True:
        steps = stored(steps, "roots")
        onward = steps.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        longer = steps.join(onward, "root", "left")
        if longer.filter("beyond is not null").isEmpty():
            break
        steps = longer.select("word", F.coalesce("beyond", "root").alias("root"))
    return found.join(steps, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
