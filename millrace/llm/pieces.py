"""Sampled segmentations over a SentencePiece lattice, and decoding.

The pieces that a text may be made of form a lattice. A forward pass sums the weights of
all ways to every place (filtering), and pieces are then drawn from the end back to the
beginning (sampling), so a segmentation comes up with its share of the total. The
random numbers are a hash of the row's key and the place in the text: the same row gets the same
pieces in every run, whatever the partitions.

The model file gives pieces in order of rank; a piece weighs ``1 / (rank + 1) ** ALPHA``. Pieces span no
word, so the lattice falls apart into one per word. The lattices of all distinct words of a batch are
built together, one place after the other, and so are the drawings of all its words. Characters without a piece, and the mark for spaces where a text holds it itself,
become byte pieces, so decoding gives back every text.

Cases: a missing or empty text has no piece and decodes to an empty one. A missing id
is a key like any other, and repeated rows get the same pieces. An empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_and_text
from .vocab import tokenizer_path

MODEL = "piece_bpe_32k.model"
ALPHA = 1.0
SPACE = "▁"
# Characters sampled together.
TOGETHER = 2_000_000
# Steps of a share; with the number of a place below 2^25 they are exact in a float.
FINE = float(1 << 28)
# Rows decoded together.
ROWS = 500


class Vocabulary:
    """Pieces of a model file, their weights, and what they decode to."""

    def __init__(self, path: str, alpha: float = ALPHA):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.ids: dict[str, int] = {}
        self.bytes = [0] * 256
        self.raw = [b""] * size
        ranks = np.zeros(size)
        for i in range(size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(piece[3:-1], 16)
                self.bytes[value], self.raw[i] = i, bytes([value])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                ranks[i] = i
                self.ids[piece] = i
                self.raw[i] = piece.replace(SPACE, " ").encode()
        first = min(self.ids.values())
        self.log_weights = -alpha * np.log(np.maximum(ranks - first, 0) + 1)
        self.log_byte = -alpha * np.log(size)
        # The pieces as a tree of beginnings: numbers of characters, the steps as sorted numbers,
        # where they lead, and the piece that ends there.
        letters = {c: n for n, c in enumerate(sorted({c for p in self.ids for c in p}), 1)}
        self.letters = np.zeros(0x110000, np.int32)
        for c, n in letters.items():
            self.letters[ord(c)] = n
        self.bits = len(letters).bit_length()
        nodes = {"": 0}
        steps = {}
        for piece in self.ids:
            for n in range(1, len(piece) + 1):
                if piece[:n] not in nodes:
                    nodes[piece[:n]] = len(nodes)
                    steps[nodes[piece[: n - 1]] << self.bits | letters[piece[n - 1]]] = nodes[piece[:n]]
        kind = np.int32 if len(nodes) << self.bits < 1 << 31 else np.int64
        self.steps = np.array(sorted(steps), kind)
        self.leads = np.array([steps[k] for k in self.steps.tolist()], kind)
        self.ends = np.full(len(nodes), -1, np.int32)
        for piece, i in self.ids.items():
            self.ends[nodes[piece]] = i

        self.spelled = pa.array(self.raw, pa.binary())

    def decode(self, column: pa.Array) -> pa.Array:
        """Texts of ids in little-endian unsigned 32-bit; the space before the first word is no part of them."""
        column = column.fill_null(b"")
        ends = np.append(0, np.cumsum(pc.binary_length(column).to_numpy(zero_copy_only=False) // 4))
        raw = np.frombuffer(pc.binary_join(pa.ListArray.from_arrays([0, len(column)], column), b"")[0].as_buffer(), "<u4")
        parts = self.spelled.take(pa.array(raw.astype(np.int32)))
        texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), parts), b"")
        return pc.utf8_slice_codeunits(texts.cast(pa.string()), 1)


@lru_cache(maxsize=4)
def vocabulary(path: str, alpha: float = ALPHA) -> Vocabulary:
    return Vocabulary(path, alpha)


def _heads(begin: np.ndarray, end: np.ndarray, n: int) -> np.ndarray:
    """First places of the stretches that ``n`` places fall into: no edge leads from one to the next."""
    across = np.cumsum(np.bincount(begin, minlength=n) - np.bincount(end, minlength=n))
    return np.flatnonzero(np.append(0, across)[:n] == 0)


def lattice(words: list[str], vocab: Vocabulary) -> tuple[np.ndarray, ...]:
    """Edges of the lattices of many words, by the place they end at.

    Places are numbered through: a word of n characters has n, the ends of its characters.
    Gives, per edge, the characters it spans, its piece, and the share of all ways to its end that
    come through it or an edge before, lifted by the number of the place; and per place
    the edges so far. A character without a piece has its code point, made negative and less
    one, as piece.
    """
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    text = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int32)
    letters = vocab.letters[text]
    n = len(text)
    left = (np.repeat(np.cumsum(lengths), lengths) - np.arange(n)).astype(np.int32)  # to the word's end
    found_at, found_pieces = [], []
    at, node = np.arange(n, dtype=np.int32), np.zeros(n, vocab.steps.dtype)
    while len(at):
        width = len(found_at)
        wanted = node << vocab.bits | letters[at + width]
        place = np.minimum(np.searchsorted(vocab.steps, wanted), len(vocab.steps) - 1)
        found = vocab.steps[place] == wanted
        at, node = at[found], vocab.leads[place[found]]
        piece = vocab.ends[node]
        whole = piece >= 0
        own, drawn = at[whole], piece[whole]
        if not width:
            alone = np.ones(n, bool)
            alone[own] = False
            odd = np.flatnonzero(alone).astype(np.int32)
            own, drawn = np.append(own, odd), np.append(drawn, -text[odd] - 1)
        found_at.append(own)
        found_pieces.append(drawn)
        more = left[at] > width + 1
        at, node = at[more], node[more]
    # In the order of their ends; an end has one edge of each width at most.
    count = np.zeros(n, np.int32)
    for width, own in enumerate(found_at):
        count[own + width] += 1
    last = np.cumsum(count, dtype=np.int64)
    free = last - count
    total = int(last[-1]) if n else 0
    begin, span, piece = (np.empty(total, np.int32) for _ in range(3))
    for width, (own, drawn) in enumerate(zip(found_at, found_pieces, strict=True)):
        to = free[own + width]
        begin[to], span[to], piece[to] = own, width + 1, drawn
        free[own + width] += 1
    end = begin + span - 1
    weight = np.where(piece >= 0, vocab.log_weights[np.maximum(piece, 0)], 0.0)
    odd = piece < 0
    size = 1 + (-piece[odd] > 0x80) + (-piece[odd] > 0x800) + (-piece[odd] > 0x10000)
    weight[odd] = size * vocab.log_byte
    # All ways pass the end of a stretch, so each stretch counts from its own beginning.
    heads = _heads(begin, end, n)
    inside = (np.arange(n) - np.repeat(heads, np.diff(np.append(heads, n)))).astype(np.int32)
    # Ways to every place, place after place of all stretches; in logarithms, as they may be long.
    ways = np.zeros(n + 1)  # the last stands for the beginning of any stretch
    before = np.where(inside[begin] > 0, begin - 1, n)
    depth = inside[end]
    # Sixteen bits are sorted in linear time.
    narrow = depth.astype(np.uint16) if n and int(inside.max()) < 1 << 16 else depth
    by_depth = np.argsort(narrow, kind="stable")
    bounds = np.searchsorted(depth[by_depth], np.arange(int(depth.max()) + 2 if len(depth) else 1))
    for low, high in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        own = by_depth[low:high]
        value = ways[before[own]] + weight[own]
        to = end[own]
        first = np.flatnonzero(np.append(True, to[1:] != to[:-1]))
        most = np.maximum.reduceat(value, first)
        sizes = np.diff(np.append(first, len(own)))
        ways[to[first]] = most + np.log(np.add.reduceat(np.exp(value - np.repeat(most, sizes)), first))
    share = np.exp(ways[before] + weight - ways[end])
    # Summed per place and rounded to what stays exact beside any place's number, so that
    # a draw does not depend on the words that are in the same batch.
    first, many, k = last - count, count, 1
    while len(first):
        more = many > k
        first, many = first[more], many[more]
        share[first + k] += share[first + k - 1]
        k += 1
    return span, piece, np.round(share * FINE) / FINE + end, last


def _mixed(z: np.ndarray) -> np.ndarray:
    """64-bit numbers hashed to 64-bit numbers."""
    z = z + np.uint64(0x9E3779B97F4A7C15)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def seed_of(key) -> int:
    import xxhash

    return xxhash.xxh64_intdigest("" if key is None else str(key), 7)


def _absent(column: pa.Array, count: int) -> list[str]:
    """Characters that none of the texts has."""
    found = []
    for code in (*range(0xFDD0, 0xFDF0), *range(0xF0000, 0x10FFFF)):
        if not pc.any(pc.match_substring(column, chr(code))).as_py():
            found.append(chr(code))
            if len(found) == count:
                break
    return found


class Sampler:
    """Draws segmentations of many texts at once."""

    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab

    def sample(self, column: pa.Array | list[str], seeds: list[int]) -> list[bytes]:
        """Ids of each text, as little-endian unsigned 32-bit integers."""
        if not isinstance(column, pa.Array):
            column = pa.array(column, pa.string())
        if not len(column):
            return []
        cut, mark = _absent(column, 2)
        # Marks of the text itself become a character without a piece.
        text = pc.replace_substring(column, SPACE, mark)
        text = pc.replace_substring_regex(text, "( +)", cut + r"\1")
        text = pc.replace_substring(text, " ", SPACE)
        lead = pc.if_else(pc.equal(column, ""), "", SPACE)
        lists = pc.split_pattern(pc.binary_join_element_wise(lead, text, ""), cut)
        every = lists.flatten().dictionary_encode()
        words = every.indices.to_numpy()
        distinct = every.dictionary.to_pylist()
        per_text = pc.list_value_length(lists).to_numpy()
        span, piece, lifted, last = lattice(distinct, self.vocab)
        lengths = np.fromiter(map(len, distinct), np.int64, len(distinct))
        # Stretches of words are drawn side by side, so a long word takes no more steps than a long stretch.
        places = np.repeat(np.arange(len(last)), np.diff(np.append(0, last)))
        heads = _heads(places - span + 1, places, len(last))
        low, high = (np.searchsorted(heads, c) for c in (np.cumsum(lengths) - lengths, np.cumsum(lengths)))
        many = (high - low)[words]
        after = np.cumsum(many)
        stretch = np.repeat(low[words] - (after - many), many) + np.arange(many.sum())
        per_text = np.diff(np.append(0, after)[np.append(0, np.cumsum(per_text))])
        base = heads[stretch]
        at = np.diff(np.append(heads, len(last)))[stretch]
        ends = np.cumsum(at)
        text_ends = np.cumsum(per_text)
        through = np.append(0, ends)[np.append(0, text_ends)]
        begin = ends - at - np.repeat(through[:-1], per_text)  # in the text
        seed = np.repeat(np.array(seeds, np.uint64), per_text)
        active = np.flatnonzero(at > 0)
        node = base[active] + at[active] - 1
        place = begin[active] + at[active]
        key = seed[active]
        first = base[active]
        steps = []
        while len(active):
            mixed = _mixed(key + place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            u = (mixed >> np.uint64(36)) / FINE
            edge = np.minimum(np.searchsorted(lifted, node + u, "right"), last[node] - 1)
            steps.append((active, piece[edge]))
            moved = span[edge]
            node = node - moved
            more = node >= first
            active, node, place, key, first = (
                active[more], node[more], (place - moved)[more], key[more], first[more]
            )
        # Steps go backward from the end of each stretch.
        taken = np.zeros(len(at), np.int64)
        for own, _ in steps:
            taken[own] += 1
        after = np.cumsum(taken)
        ids = np.zeros(int(after[-1]) if len(after) else 0, np.int64)
        for k, (own, drawn) in enumerate(steps):
            ids[after[own] - 1 - k] = drawn
        bounds = np.append(0, after)[np.append(0, text_ends)]
        ids, bounds = self._spelled(ids, bounds, mark)
        raw = ids.astype("<u4")
        return [raw[a:b].tobytes() for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]

    def _spelled(self, ids: np.ndarray, bounds: np.ndarray, mark: str) -> tuple[np.ndarray, np.ndarray]:
        """Characters without a piece as byte pieces."""
        if not (ids < 0).any():
            return ids, bounds
        odd = np.flatnonzero(ids < 0)
        codes, which = np.unique(ids[odd], return_inverse=True)
        chars = [SPACE if (c := chr(-code - 1)) == mark else c for code in codes.tolist()]
        spelling = [[self.vocab.bytes[b] for b in c.encode("utf-8", "surrogatepass")] for c in chars]
        sizes = np.fromiter(map(len, spelling), np.int64, len(spelling))
        times = np.ones(len(ids), np.int64)
        times[odd] = sizes[which]
        begin = np.cumsum(times) - times
        out = np.repeat(ids, times)
        nth = np.arange(times[odd].sum()) - np.repeat(np.cumsum(times[odd]) - times[odd], times[odd])
        from_ = np.repeat((np.cumsum(sizes) - sizes)[which], times[odd]) + nth
        out[np.repeat(begin[odd], times[odd]) + nth] = np.concatenate(spelling)[from_]
        return out, np.append(0, np.cumsum(times))[bounds]


@lru_cache(maxsize=4)
def sampler(path: str, alpha: float = ALPHA) -> Sampler:
    """One sampler per Python worker."""
    return Sampler(vocabulary(path, alpha))


# --- Over tables ---------------------------------------------------------------


def sampled(docs: DataFrame, model: str | None = None, alpha: float = ALPHA) -> DataFrame:
    """``doc_id, ids`` (little-endian unsigned 32-bit) and ``text_crc32`` of the text."""
    path = model or tokenizer_path(MODEL)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        draw = sampler(path, alpha)
        for batch in batches:
            seeds = [seed_of(k) for k in batch.column("doc_id").to_pylist()]
            sizes = np.cumsum(pc.utf8_length(batch.column("text")).to_numpy().astype(np.int64))
            first = 0
            while first < batch.num_rows:
                done = sizes[first - 1] if first else 0
                stop = max(first + 1, int(np.searchsorted(sizes, done + TOGETHER, "right")))
                part = batch.slice(first, stop - first)
                found = draw.sample(part.column("text"), seeds[first:stop])
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("text_crc32"), pa.array(found, pa.binary())],
                    ["doc_id", "text_crc32", "ids"],
                )
                first = stop

    rows = id_and_text(docs).withColumn("text_crc32", F.crc32(F.col("text").cast("binary")))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, text_crc32 bigint, ids binary")


def decoded(encoded: DataFrame, model: str | None = None) -> DataFrame:
    """``encoded`` (with a column ``ids``) and the text that the ids decode to, as ``decoded``."""
    path = model or tokenizer_path(MODEL)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        for batch in batches:
            for first in range(0, batch.num_rows, ROWS):
                part = batch.slice(first, ROWS)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, vocab.decode(part.column("ids"))], [*batch.schema.names, "decoded"]
                )

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema)
    return encoded.mapInArrow(run, f"{ddl}, decoded string")
