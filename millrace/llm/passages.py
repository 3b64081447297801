"""Substring deduplication by automata of repeated phrases.

A window is ``WINDOW`` consecutive words of a document. Of the windows with one word
sequence the first stays, by document and place; words under any other are removed.

1. Anchors. Every window has one: the least hash among its runs of ``GRAM`` words. Equal
   windows have equal anchors, so a window whose anchor occurs once in the corpus is not
   repeated. Documents are dealt into slices of about ``SLICE`` bytes, anchors are
   counted over all slices, and go back to the slices that have repeated ones.
2. Confirmed windows. Only windows of repeated anchors are counted, by 128 bits of their
   words, one row a slice for each. Where several rows or occurrences meet they are confirmed, and
   the first in order is the one that stays.
3. Automata. Each slice compiles its confirmed windows into Aho-Corasick automata, of at most
   ``SHARD`` windows each, over phrases of ``PHRASE`` words as symbols. All documents of the slice
   with a window to look for stream through them, which finds every occurrence.

Copies of whole texts skip 2 and 3: their windows all start earlier in the document with the
smallest id. A passage in very many documents is one row a slice wherever it is counted.

Cases: a missing text is an empty one, with no words and the digest of no bytes. A missing id
comes after all others. Rows alike in id and text are one document, whose result
every one of them gets; different texts with one id are ordered by their slice, then by text. Fewer than ``WINDOW``
words have no window. A long text is a slice alone. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache
from itertools import groupby

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import id_and_text, stored

WINDOW, GRAM, PHRASE = 20, 8, 10
# A symbol is written as so many letters of an alphabet of its place, of so many bits each.
LETTERS, BITS = 4, 5
SLICE, SHARD = 2 << 20, 50_000
_SPACES = np.zeros(256, bool)
_SPACES[[9, 10, 11, 12, 13, 32]] = True
# Bytes or words hashed at a time; words above so many bytes are hashed apart.
_BLOCK, _LONG, _GROUP = 1 << 20, 4096, 4 << 20
_ROWS, _TASK_SLICES = 200_000, 2


def _mixed(x: np.ndarray) -> np.ndarray:
    """Numbers of 64 bits spread over all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Hash:
    """A polynomial hash of runs, from differences of running sums."""

    def __init__(self, base: int):
        self.base = base
        size = _BLOCK + _LONG + 1
        inverse = pow(base, -1, 1 << 64)
        self.up, self.down = (
            np.multiply.accumulate(np.r_[np.uint64(1), np.full(size, b, np.uint64)]) for b in (base, inverse)
        )
        self.letter = _mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(base))

    def _runs(self, values, start, end) -> np.ndarray:
        """Hashes of ``values[start:end]``, with at most ``_LONG`` in each run; sorted by start."""
        found = np.empty(len(start), np.uint64)
        first = 0
        while first < len(start):
            origin = start[first]
            last = np.searchsorted(start, origin + _BLOCK)
            a, b = start[first:last] - origin, end[first:last] - origin
            part = values(origin, origin + b.max())
            sums = np.r_[np.uint64(0), np.cumsum(part * self.up[: len(part)])]
            found[first:last] = (sums[b] - sums[a]) * self.down[a]
            first = last
        return _mixed(found)

    def words(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        found = self._runs(lambda a, b: self.letter[data[a:b]], start, np.minimum(end, start + _LONG))
        for at in np.flatnonzero(end - start > _LONG):
            found[at] = xxhash.xxh64_intdigest(data[start[at] : end[at]].tobytes(), self.base & 0xFFFF)
        return found

    def grams(self, words: np.ndarray, size: int) -> np.ndarray:
        """Hashes of all runs of ``size`` words."""
        start = np.arange(max(len(words) - size + 1, 0))
        return self._runs(lambda a, b: words[a:b], start, start + size)


@cache
def _hashes() -> tuple[_Hash, _Hash]:
    return _Hash(0x9E3779B97F4A7C15), _Hash(0xD6E8FEB86659FD93)


class _Words:
    """Where the words of some texts are."""

    def __init__(self, texts: list[bytes]):
        self.data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        inside = np.r_[False, ~_SPACES[self.data]]
        change = np.flatnonzero(inside[1:] != inside[:-1])
        self.start, self.end = change[::2], change[1::2]
        self.doc = np.searchsorted(np.cumsum(sizes), self.start, side="right")
        self.count = np.bincount(self.doc, minlength=len(texts))

    def hashed(self, which: int = 0) -> np.ndarray:
        return _hashes()[which].words(self.data, self.start, self.end)

    def windows(self) -> np.ndarray:
        """First words of the windows."""
        n = len(self.doc) - WINDOW + 1
        return np.flatnonzero(self.doc[: max(n, 0)] == self.doc[WINDOW - 1 :])


def _sliding(values: np.ndarray, size: int, best) -> np.ndarray:
    """The best of every ``size`` consecutive values."""
    have = 1
    while have * 2 <= size:
        values = best(values[:-have], values[have:])
        have *= 2
    rest = size - have
    return best(values[:-rest], values[rest:]) if rest else values


def _anchors(words: _Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First words of the windows, their anchors, and the places of all anchors' first words."""
    windows = words.windows()
    if not len(windows):
        return windows, np.zeros(0, np.uint64), windows
    grams = _hashes()[0].grams(words.hashed(), GRAM)
    span = WINDOW - GRAM + 1
    least = _sliding(grams, span, np.minimum)
    # A gram is an anchor if it is the least of a window; no window has less than its anchor.
    of_window = np.zeros(len(grams) + span - 1, np.uint64)
    of_window[windows + span - 1] = least[windows]
    seen = np.zeros(len(of_window), bool)
    seen[windows + span - 1] = True
    # Windows that hold gram p start at p - span + 1 .. p, which are p .. p + span - 1 here.
    most = _sliding(of_window, span, np.maximum)
    any_window = _sliding(seen, span, np.maximum)
    return windows, least[windows], np.flatnonzero((most == grams) & any_window)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def found(slices, texts):
        words = _Words(texts)
        _, _, places = _anchors(words)
        if not len(places):
            return
        anchors = _hashes()[0].grams(words.hashed(), GRAM)[places]
        of_slice = np.array(slices, np.int64)[words.doc[places]]
        order = np.lexsort((anchors, of_slice))
        anchors, of_slice = anchors[order], of_slice[order]
        new = np.r_[True, (anchors[1:] != anchors[:-1]) | (of_slice[1:] != of_slice[:-1])]
        times = np.diff(np.append(np.flatnonzero(new), len(new))).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [pa.array(of_slice[new]), _signed(anchors[new]), pa.array(times)], ["slice", "anchor", "n"]
        )

    for batch in batches:
        slices, texts, size = [], [], 0
        for which, text in zip(batch.column("slice").to_pylist(), batch.column("text")):
            slices.append(which)
            texts.append(text.as_py())
            size += len(texts[-1])
            if size >= _GROUP:
                yield from found(slices, texts)
                slices, texts, size = [], [], 0
        yield from found(slices, texts)


def sliced(docs: DataFrame, size: int = SLICE) -> tuple[DataFrame, int]:
    """``slice, doc_id, text`` (as bytes), and how many slices there are, by the table's size."""
    rows = id_and_text(docs)
    total = rows.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0
    count = total // size + 1
    which = F.pmod(F.xxhash64("doc_id", "text"), F.lit(count))
    return rows.select(which.alias("slice"), "doc_id", F.col("text").cast("binary").alias("text")), count


def repeated_anchors(rows: DataFrame) -> DataFrame:
    """Stored ``slice, anchor`` of the anchors that occur more than once."""
    counted = rows.select("slice", "text").mapInArrow(_anchor_rows, "slice bigint, anchor bigint, n int")
    total = F.sum("n").over(Window.partitionBy("anchor"))
    return stored(counted.withColumn("total", total).filter("total > 1").select("slice", "anchor"), "anchors")


def copies(rows: DataFrame) -> DataFrame:
    """Stored ``slice, doc_id, digest`` of the documents whose text a smaller id has, too."""
    each = rows.select("slice", "doc_id", F.unhex(F.sha2("text", 256)).alias("digest"))
    groups = each.groupBy("digest").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("n"))
    # Stored, so that the join's sides come from shuffles and a hot digest is split.
    groups = stored(groups.filter("n > 1").select("digest", "keep_id"), "copies")
    found = each.join(groups, "digest").filter(~F.col("doc_id").eqNullSafe(F.col("keep_id")))
    return stored(found.select("slice", "doc_id", "digest"), "copies")


_RESULT = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string"
_OPEN = "slice bigint, doc_ids array<bigint>, times array<int>, texts array<binary>, starts binary"
_SETTLED_FIELDS = [
    ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())
]
_OPEN_FIELDS = [
    ("slice", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("times", pa.list_(pa.int32())),
    ("texts", pa.list_(pa.binary())), ("starts", pa.binary()),
]


def _record(rows: list[tuple], fields) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[] for _ in fields]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, fields)], schema=pa.schema(fields))


def _digest(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def _by_slice(batches, kinds: tuple[str, ...]):
    """``slice, {kind: rows}`` from rows sorted by slice."""

    def rows():
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("slice", "kind", *kinds)]
            yield from zip(*columns)

    for which, group in groupby(rows(), key=lambda row: row[0]):
        yield which, group


def _settle(batches):
    """Documents without a window that may be repeated, with their results, and the others by slice."""
    for which, group in _by_slice(batches, ("doc_id", "value", "anchors")):
        repeated, gone, docs = np.zeros(0, np.int64), set(), {}
        for _, kind, doc_id, value, anchors in group:
            if kind == 0:
                repeated = np.sort(np.array(anchors, np.int64))
            elif kind == 1:
                gone.add((doc_id, value))
            else:
                docs[doc_id, value] = docs.get((doc_id, value), 0) + 1
        order = sorted(docs, key=lambda d: (d[0] is None, d[0] or 0, d[1]))
        texts = [text for _, text in order]
        words = _Words(texts)
        windows, anchors, _ = _anchors(words)
        may = np.isin(anchors.view(np.int64), repeated)
        is_copy = np.array([(i, hashlib.sha256(t).digest()) in gone for i, t in order], bool)
        may &= ~is_copy[words.doc[windows]]
        is_open = np.zeros(len(order), bool)
        is_open[words.doc[windows[may]]] = True
        done = []
        for at, (doc_id, text) in enumerate(order):
            if not is_open[at]:
                n = int(words.count[at])
                all_gone = bool(is_copy[at]) and n >= WINDOW
                row = doc_id, n, n if all_gone else 0, _digest([] if all_gone else text.split())
                done += [row] * docs[doc_id, text]
        yield _pad(_record(done, _SETTLED_FIELDS), _OPEN_FIELDS, first=True)
        if is_open.any():
            # Places among the words of the open documents.
            kept = is_open[words.doc]
            place = np.cumsum(kept) - 1
            starts = place[windows[may]].astype("<i4").tobytes()
            chosen = np.flatnonzero(is_open)
            row = (
                which, [order[at][0] for at in chosen], [docs[order[at]] for at in chosen],
                [texts[at] for at in chosen], starts,
            )
            yield _pad(_record([row], _OPEN_FIELDS), _SETTLED_FIELDS, first=False)


def _pad(rows: pa.RecordBatch, others, first: bool) -> pa.RecordBatch:
    """The rows with empty columns after or before theirs."""
    empty = [pa.nulls(rows.num_rows, t) for _, t in others]
    mine = [rows.column(i) for i in range(rows.num_columns)]
    names = rows.schema.names
    others = [name for name, _ in others]
    if first:
        return pa.RecordBatch.from_arrays(mine + empty, names + others)
    return pa.RecordBatch.from_arrays(empty + mine, others + names)


def settled(rows: DataFrame, slices: int) -> DataFrame:
    """Stored results of the documents that no confirmed window can touch, and open slices."""
    anchors = repeated_anchors(rows).groupBy("slice").agg(F.collect_list("anchor").alias("anchors"))
    nothing = F.lit(None)
    parts = (
        anchors.select(
            "slice", F.lit(0).alias("kind"), nothing.cast("bigint").alias("doc_id"),
            nothing.cast("binary").alias("value"), "anchors",
        )
        .unionByName(
            copies(rows).select(
                "slice", F.lit(1).alias("kind"), "doc_id", F.col("digest").alias("value"),
                nothing.cast("array<bigint>").alias("anchors"),
            )
        )
        .unionByName(
            rows.select(
                "slice", F.lit(2).alias("kind"), "doc_id", F.col("text").alias("value"),
                nothing.cast("array<bigint>").alias("anchors"),
            )
        )
    )
    # A few slices a task, whatever the table's size.
    tasks = -(-slices // _TASK_SLICES)
    dealt = parts.repartition(tasks, "slice").sortWithinPartitions("slice", "kind")
    return stored(dealt.mapInArrow(_settle, f"{_RESULT}, {_OPEN}"), "settled")


def _window_rows(batches):
    """Each distinct window of a slice that may be repeated, where it is first and how often."""
    for batch in batches:
        for row in batch.to_pylist():
            words = _Words(row["texts"])
            starts = np.frombuffer(row["starts"], "<i4").astype(np.int64)
            high, low = (_hashes()[w].grams(words.hashed(w), WINDOW)[starts] for w in (0, 1))
            order = np.lexsort((starts, low, high))
            high, low, starts = high[order], low[order], starts[order]
            new = np.flatnonzero(np.r_[True, (high[1:] != high[:-1]) | (low[1:] != low[:-1])])
            times = np.diff(np.append(new, len(starts)))
            ids = pa.array(row["doc_ids"], pa.int64()).take(pa.array(words.doc[starts[new]]))
            for at in range(0, len(new), _ROWS):
                part = slice(at, at + _ROWS)
                here = new[part]
                yield pa.RecordBatch.from_arrays(
                    [
                        _signed(high[here]), _signed(low[here]), ids.slice(at, len(here)),
                        pa.array(np.full(len(here), row["slice"], np.int64)),
                        pa.array(starts[here].astype(np.int32)), pa.array((times[part] > 1)),
                    ],
                    ["high", "low", "doc_id", "slice", "at", "again"],
                )


def confirmed(open_slices: DataFrame) -> DataFrame:
    """Stored ``slice, places``: the repeated windows of each slice, ``2 * place``, plus one where the
    first of the whole corpus is there."""
    each = open_slices.select("slice", "doc_ids", "texts", "starts").mapInArrow(
        _window_rows, "high bigint, low bigint, doc_id bigint, slice bigint, at int, again boolean"
    )
    same = Window.partitionBy("high", "low").orderBy(F.asc_nulls_last("doc_id"), "slice", "at")
    placed = each.withColumn("nth", F.row_number().over(same)).withColumn("next", F.lead("slice").over(same))
    repeated = placed.filter("nth > 1 or next is not null or again")
    place = F.col("at").cast("bigint") * 2 + (F.col("nth") == 1).cast("bigint")
    return stored(
        repeated.select("slice", place.alias("place")).groupBy("slice").agg(F.collect_list("place").alias("places")),
        "confirmed",
    )


def _phrases(numbers: np.ndarray) -> np.ndarray:
    """Numbers from 1 of the runs of ``PHRASE`` words at every place, the same for equal ones."""
    def joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return np.unique(left * (int(right.max(initial=0)) + 1) + right, return_inverse=True)[1].astype(np.int64)

    # Runs of two words, then of two of these, and so on; the binary digits of the length tell how.
    whole, size = None, 0
    power, length = numbers, 1
    while True:
        if PHRASE & length:
            n = len(numbers) - size - length + 1
            whole = power if whole is None else joined(whole[:n], power[size : size + n])
            size += length
        if 2 * length > PHRASE:
            return whole + 1
        power, length = joined(power[:-length], power[length:]), 2 * length


def _text(symbols: np.ndarray) -> str:
    """Symbols as letters, so that no node of an automaton has many children; 0 matches nothing.

    Each place of a symbol has letters of its own, so a match begins and ends with whole symbols.
    """
    place = np.arange(LETTERS)
    digit = symbols[:, None] >> (BITS * (LETTERS - 1 - place)) & ((1 << BITS) - 1)
    letters = np.where(symbols[:, None] > 0, digit + (place << BITS) + 1, 0)
    return letters.astype(np.uint8).tobytes().decode("latin-1")


def located(numbers: np.ndarray, starts: np.ndarray, shard: int = SHARD) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``places, starts``: every place at which the window that begins at a start occurs.

    ``numbers`` are the words by number from 1, with 0 between documents. The windows that start at
    ``starts`` are distinct. Symbols are phrases of ``PHRASE`` words, so a window is two symbols of
    the text read in steps of a phrase, from each of its first places.
    """
    if not len(starts):
        return
    phrases = _phrases(numbers)
    steps = WINDOW // PHRASE
    # The text in steps of a phrase, one row for each first place, with a break after each.
    width = -(-len(phrases) // PHRASE) + 1
    rows = np.zeros((PHRASE, width), np.int64)
    for first in range(PHRASE):
        own = phrases[first::PHRASE]
        rows[first, : len(own)] = own
    rows = rows.ravel()

    def at_row(places: np.ndarray) -> np.ndarray:
        return places % PHRASE * width + places // PHRASE

    for first in range(0, len(starts), shard):
        chosen = starts[first : first + shard]
        begin = at_row(chosen)
        # Phrases outside the chosen windows match nothing, so they all are symbol 0.
        used = np.unique(rows[begin[:, None] + np.arange(steps)])
        symbol = np.zeros(int(rows.max()) + 1, np.int64)
        symbol[used] = np.arange(1, len(used) + 1)
        text = _text(symbol[rows])
        automaton = ahocorasick.Automaton()
        for nth, at in enumerate(begin.tolist()):
            automaton.add_word(text[at * LETTERS : (at + steps) * LETTERS], nth)
        automaton.make_automaton()
        found = np.array(list(automaton.iter(text)), np.int64).reshape(-1, 2)
        end = found[:, 0] // LETTERS - (steps - 1)
        yield end % width * PHRASE + end // width, chosen[found[:, 1]]


def _remove(batches):
    for batch in batches:
        for row in batch.to_pylist():
            lists = [text.split() for text in row["texts"]]
            number: dict[bytes, int] = {}
            parts = []
            for words in lists:
                parts.append(np.fromiter((number.setdefault(w, len(number) + 1) for w in words), np.int64, len(words)))
                parts.append(np.zeros(1, np.int64))
            numbers = np.concatenate(parts)
            # Places among all words to places among words and the breaks after documents.
            many = np.fromiter(map(len, lists), np.int64, len(lists))
            with_breaks = np.arange(int(many.sum())) + np.repeat(np.arange(len(lists)), many)
            places = np.sort(np.array(row["places"] or [], np.int64))
            starts = with_breaks[places >> 1]
            stays = np.zeros(len(numbers), bool)
            stays[starts[places & 1 == 1]] = True
            change = np.zeros(len(numbers) + 1, np.int64)
            for at, start in located(numbers, starts):
                marked = at[(at != start) | ~stays[start]]
                # A place is found once, as the windows are distinct.
                change[marked] += 1
                change[marked + WINDOW] -= 1
            covered = np.cumsum(change) > 0
            done, begin = [], 0
            for doc_id, times, words in zip(row["doc_ids"], row["times"], lists):
                gone = covered[begin : begin + len(words)]
                begin += len(words) + 1
                kept = [w for w, out in zip(words, gone.tolist()) if not out]
                done += [(doc_id, len(words), len(words) - len(kept), _digest(kept))] * times
            yield _record(done, _SETTLED_FIELDS)


def deduplicated(docs: DataFrame, size: int = SLICE) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` for every row."""
    found = settled(*sliced(docs, size))
    open_slices = found.filter("slice is not null").select("slice", "doc_ids", "times", "texts", "starts")
    places = confirmed(open_slices)
    rest = open_slices.drop("starts").join(places, "slice", "left").mapInArrow(_remove, _RESULT)
    done = found.filter("slice is null").select("doc_id", "n_words", "n_removed", "kept_sha256")
    return done.unionByName(rest)
