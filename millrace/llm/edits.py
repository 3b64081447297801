"""Token counts that follow edits.

A text is cut at places where a token surely begins: a single space between two
characters that are no white space, or either side of such a line break. A tree over blocks of
such segments keeps, per node, the characters and tokens below it. An edit finds its segments by
descending on characters; only they and the context up to one segment on either side that is not
white space alone are cut and encoded anew, and the sums on the way to the root follow. Blocks that no edit touches stay stretches of
the first text. Counts equal those of encoding the edited text whole.

Cases: a missing or empty text has no segment and no token, and edits may fill it.
Edits apply in order, each to the text that the one before left; a missing list is an
empty one, places beyond the end mean the end, negative ones the beginning, a missing
inserted text nothing. Missing ids and repeated rows are rows like any other. An
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .vocab import encoder, tokenizer_path

# Segments of a block, a leaf of the tree, when it is built.
BLOCK = 32
EDITS = "array<struct<start: bigint, removed: bigint, inserted: string>>"
# Rows whose trees are held together.
ROWS = 1_000
# Segments that are looked up one by one.
FEW = 64


def segments(text: str) -> list[str]:
    """The text cut before single spaces between other characters."""
    if not text:
        return []
    found, words = [], text.split(" ")
    held = words[0]
    for before, word in zip(words, words[1:]):
        if before and word and not before[-1].isspace() and not word[0].isspace():
            found.append(held)
            held = " " + word
        else:
            held += " " + word
    found.append(held)
    return found


class Counter:
    """Tokens of segments: those of an edit one by one, those of a text together."""

    def __init__(self, path: str, special: bool = False):
        self._encoder = encoder(path, special)
        self.named = self._encoder.named

    def __call__(self, parts: list[str]) -> list[int]:
        if len(parts) <= FEW:
            return self._encoder.count_few(parts)
        return [len(ids) // 4 for ids in self._encoder.encode(parts)]


@lru_cache(maxsize=4)
def counter(path: str, special: bool = False) -> Counter:
    """One counter per Python worker."""
    return Counter(path, special)


class Tree:
    """Blocks of segments under sums of their characters and tokens."""

    def __init__(self, text: str, chars: np.ndarray, tokens: np.ndarray):
        self.encoded = 0  # segments encoded for edits
        self._build(text, np.asarray(chars, np.int64), np.asarray(tokens, np.int64))

    def _build(self, text: str, chars: np.ndarray, tokens: np.ndarray) -> None:
        self._base = text, chars, tokens
        count = max(1, -(-len(chars) // BLOCK))
        self.leaves = 1 << (count - 1).bit_length()
        first = np.arange(0, len(chars), BLOCK)
        self.chars = self._sums(np.add.reduceat(chars, first) if len(first) else chars)
        self.tokens = self._sums(np.add.reduceat(tokens, first) if len(first) else tokens)
        self._at = np.append(0, np.cumsum(self.chars[self.leaves : self.leaves + count])).tolist()
        # Segments and tokens of the blocks that were edited.
        self.blocks: list[tuple[list[str], list[int]] | None] = [None] * count

    def _sums(self, leaves: np.ndarray) -> list[int]:
        row = np.zeros(self.leaves, np.int64)
        row[: len(leaves)] = leaves
        rows = [row]
        while len(row) > 1:
            row = row[::2] + row[1::2]
            rows.append(row)
        return np.concatenate([[0], *rows[::-1]]).tolist()

    @property
    def n_tokens(self) -> int:
        return self.tokens[1]

    def _block(self, i: int) -> tuple[list[str], list[int]]:
        if self.blocks[i] is None:
            text, chars, tokens = self._base
            own = slice(i * BLOCK, (i + 1) * BLOCK)
            parts, at = [], self._at[i]
            for n in chars[own].tolist():
                parts.append(text[at : at + n])
                at += n
            return parts, tokens[own].tolist()
        return self.blocks[i]

    def _stretches(self) -> Iterator[tuple[int, int] | int]:
        """Runs of blocks as they were, and edited blocks one by one."""
        begin = 0
        for i, block in enumerate(self.blocks):
            if block is not None:
                if begin < i:
                    yield begin, i
                yield i
                begin = i + 1
        if begin < len(self.blocks):
            yield begin, len(self.blocks)

    def parts(self) -> tuple[np.ndarray, np.ndarray]:
        """Characters and tokens of all segments."""
        _, chars, tokens = self._base
        found: list[tuple] = []
        for s in self._stretches():
            if isinstance(s, int):
                own, counts = self.blocks[s]
                found.append((np.fromiter(map(len, own), np.int64, len(own)), np.array(counts, np.int64)))
            else:
                own = slice(s[0] * BLOCK, s[1] * BLOCK)
                found.append((chars[own], tokens[own]))
        return tuple(map(np.concatenate, zip(*found, strict=True)))

    def text(self) -> str:
        base = self._base[0]
        return "".join(
            "".join(self.blocks[s][0]) if isinstance(s, int) else base[self._at[s[0]] : self._at[s[1]]]
            for s in self._stretches()
        )

    def _find(self, at: int) -> tuple[int, int, int]:
        """Block, segment in it and its first character, for the segment that holds a character."""
        node, begin = 1, 0
        while node < self.leaves:
            node *= 2
            if at >= begin + self.chars[node] and self.chars[node + 1]:
                begin += self.chars[node]
                node += 1
        block = node - self.leaves
        own = self._block(block)[0]
        for i, s in enumerate(own):
            if at < begin + len(s) or i == len(own) - 1:
                return block, i, begin
            begin += len(s)
        return block, 0, begin

    def _next(self, block: int, i: int, step: int) -> tuple[int, int] | None:
        """The segment before or after; empty blocks are passed over."""
        i += step
        while not 0 <= i < len(self._block(block)[0]):
            block += step
            if not 0 <= block < len(self.blocks):
                return None
            i = 0 if step > 0 else len(self._block(block)[0]) - 1
        return block, i

    def edit(self, start: int, removed: int, inserted: str, count: Counter) -> None:
        """Replace ``removed`` characters from ``start`` by ``inserted``."""
        start = min(max(0, start), self.chars[1])
        removed = min(max(0, removed), self.chars[1] - start)
        if not removed and not inserted:
            return
        # The segments of the character before the edit and of the one after it, and one more on
        # either side: these last keep their outer ends, so the cuts there stay right.
        first = self._find(max(0, start - 1))
        last = self._find(start + removed)
        begin = first[2]
        low, high = first[:2], last[:2]
        if (more := self._next(*low, -1)) is not None:
            low = more
            begin -= len(self._block(low[0])[0][low[1]])
        high = self._next(*high, 1) or high
        # A run of white space is one stretch to the tokenizer, so the outer segments must end it.
        while self._blank(low) and (more := self._next(*low, -1)) is not None:
            low = more
            begin -= len(self._block(low[0])[0][low[1]])
        while self._blank(high) and (more := self._next(*high, 1)) is not None:
            high = more
        # White space goes with a special token that the edit makes after it.
        text = self._changed(low, high, start - begin, removed, inserted)
        while count.named(text) and self._blank(low):
            if (more := self._next(*low, -1)) is None:
                break
            low = more
            begin -= len(self._block(low[0])[0][low[1]])
            text = self._changed(low, high, start - begin, removed, inserted)
        parts = segments(text)
        tokens = count(parts)
        self.encoded += len(parts)
        self._splice(low, high, parts, tokens)

    def _blank(self, at: tuple[int, int]) -> bool:
        """Whether a segment is white space alone."""
        return "".join(self._block(at[0])[0][at[1] : at[1] + 1]).isspace()

    def _changed(self, low, high, at: int, removed: int, inserted: str) -> str:
        """The text of a run of segments after an edit."""
        window = []
        for block in range(low[0], high[0] + 1):
            own = self._block(block)[0]
            window += own[low[1] if block == low[0] else 0 : high[1] + 1 if block == high[0] else len(own)]
        text = "".join(window)
        return text[:at] + inserted + text[at + removed :]

    def _splice(self, low, high, parts: list[str], tokens: list[int]) -> None:
        own, counts = self._block(low[0])
        after, after_counts = self._block(high[0])
        head, head_counts = own[: low[1]], counts[: low[1]]
        tail, tail_counts = after[high[1] + 1 :], after_counts[high[1] + 1 :]
        for block in range(low[0], high[0] + 1):
            self.blocks[block] = ([], [])
        if low[0] == high[0]:
            self.blocks[low[0]] = (head + parts + tail, head_counts + tokens + tail_counts)
        else:
            self.blocks[low[0]] = (head + parts, head_counts + tokens)
            self.blocks[high[0]] = (tail, tail_counts)
        if len(self.blocks[low[0]][0]) > 4 * BLOCK:
            self._build(self.text(), *self.parts())
            return
        for block in range(low[0], high[0] + 1):
            node = self.leaves + block
            self.chars[node] = sum(map(len, self.blocks[block][0]))
            self.tokens[node] = sum(self.blocks[block][1])
        # Nodes above the changed leaves, level by level.
        left, right = (self.leaves + low[0]) // 2, (self.leaves + high[0]) // 2
        while left:
            for node in range(left, right + 1):
                self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]
                self.tokens[node] = self.tokens[2 * node] + self.tokens[2 * node + 1]
            left, right = left // 2, right // 2


# --- Over tables ---------------------------------------------------------------

_TREE = "segment_chars array<int>, segment_tokens array<int>"


def _leaves(column: pa.Array, path: str, special: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Characters and tokens of the segments of each text."""
    count = counter(path, special)
    for i, found in enumerate(encoder(path, special).segments(column)):
        if found is None:
            parts = segments(column[i].as_py())
            found = np.array(list(map(len, parts)), np.int64), np.array(count(parts), np.int64)
        yield found


def _lists(rows: list[np.ndarray]) -> pa.Array:
    ends = np.append(0, np.cumsum(list(map(len, rows)))).astype(np.int32)
    values = np.concatenate(rows).astype(np.int32) if rows else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values))


def built(docs: DataFrame, tokenizer: str | None = None, special: bool = False) -> DataFrame:
    """``docs`` (``doc_id, text`` and others) with the leaves of their trees."""
    path = tokenizer or tokenizer_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for first in range(0, whole.num_rows, ROWS):
                batch = whole.slice(first, ROWS)
                found = list(_leaves(batch.column("text").fill_null(""), path, special))
                leaves = [_lists([f[k] for f in found]) for k in (0, 1)]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, *leaves], [*batch.schema.names, "segment_chars", "segment_tokens"]
                )

    return docs.mapInArrow(run, f"{_ddl(docs)}, {_TREE}")


def _ddl(rows: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)


def edited(docs: DataFrame, tokenizer: str | None = None, special: bool = False) -> DataFrame:
    """Trees after the edits in the column ``edits``.

    Takes ``doc_id, text, edits`` and, if they were built before, the leaves; gives ``doc_id``, the
    edited text and its leaves, ``n_tokens`` before and ``edited_tokens`` after, and ``n_encoded``,
    the segments that were encoded for the edits.
    """
    path = tokenizer or tokenizer_path()
    kept = {"segment_chars", "segment_tokens"} <= set(docs.columns)
    names = ["text", "segment_chars", "segment_tokens", "n_tokens", "edited_tokens", "n_encoded"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path, special)
        for whole in batches:
            for first in range(0, whole.num_rows, ROWS):
                batch = whole.slice(first, ROWS)
                texts = batch.column("text").fill_null("")
                if kept:
                    pairs = zip(*[batch.column(c) for c in ("segment_chars", "segment_tokens")], strict=True)
                    leaves = ((c.values.to_numpy(), t.values.to_numpy()) for c, t in pairs)
                else:
                    leaves = _leaves(texts, path, special)
                rows = []
                for text, (chars, tokens), changes in zip(texts, leaves, batch.column("edits"), strict=True):
                    tree = Tree(text.as_py(), chars, tokens)
                    before = tree.n_tokens
                    for c in changes.as_py() or []:
                        if c:
                            tree.edit(c["start"] or 0, c["removed"] or 0, c["inserted"] or "", count)
                    rows.append((tree.text(), *tree.parts(), before, tree.n_tokens, tree.encoded))
                columns = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id"), pa.array(columns[0], pa.string()),
                        _lists(columns[1]), _lists(columns[2]),
                        *[pa.array(c, pa.int64()) for c in columns[3:]],
                    ],
                    ["doc_id", *names],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    used = ["doc_id", "text", "edits", *(["segment_chars", "segment_tokens"] if kept else [])]
    return docs.select(*used).mapInArrow(
        run,
        f"doc_id {kind}, text string, {_TREE}, n_tokens bigint, edited_tokens bigint, n_encoded bigint",
    )


def drawn_edits(docs: DataFrame) -> DataFrame:
    """``doc_id, text, edits``, and the leaves if there are any: three edits per text, drawn by its id.

    A stretch goes, a stretch is copied to another place, and a stretch is replaced by another.
    """
    text = F.coalesce("text", F.lit(""))

    def draw(k: int, below):
        return F.pmod(F.xxhash64("doc_id", F.lit(k)), F.greatest(F.lit(1), below)).cast("bigint")

    size = F.length(text).cast("bigint")

    def stretch(k: int):
        return F.substring(text, (draw(k, size) + 1).cast("int"), draw(k + 1, F.lit(60)).cast("int"))

    def change(start, removed, inserted):
        return F.struct(start.alias("start"), removed.alias("removed"), inserted.alias("inserted"))

    changes = F.array(
        change(draw(1, size), draw(2, F.lit(80)), F.lit("")),
        change(draw(3, size), F.lit(0).cast("bigint"), stretch(4)),
        change(draw(6, size), draw(7, F.lit(40)), stretch(8)),
    )
    leaves = [c for c in ("segment_chars", "segment_tokens") if c in docs.columns]
    return docs.select("doc_id", text.alias("text"), changes.alias("edits"), *leaves)
