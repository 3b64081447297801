"""Fast use of a public byte-level BPE tokenizer inside tasks.

A byte-level BPE encodes each pre-token on its own, and a pre-token never goes
on past a space or a line break, except in a run of white space. So texts
are cut at spaces and line breaks; the distinct words of a batch are looked up in what the
worker remembers, the rest is encoded by the tokenizers library, and the ids of the texts are
put together from them. The result is what the library gives for the whole text; texts with
longer runs of white space go to it whole.

By default the name of a special token in a text is text; with ``special`` it is that token, as
in the library's own default, and the text before and after is encoded apart.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BYTE_BPE = "byte_bpe_50k.json"
# Two generations of remembered words; the older one goes when the younger is full.
REMEMBERED = 300_000
# Characters whose words are looked up together, and the most of one text at a time.
TOGETHER = 4_000_000
# New words that the library gets at a time; more take longer a word.
LEARNED = 200
# A space or line break inside a longer run of white space starts no pre-token.
_RUN = re.compile(r"\s[ \n](?:\s|\Z)|[ \n]\s\Z|\n\s\s|\0")
# Any two of these together, other white space, or the mark used for cutting.
_DOUBT = (
    r"[ \n][ \n]|[\x00\t\v\f\r\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
# White space other than the space before a word.
_INNER = re.compile(r"[^\S ]")
# A place where a text may always be cut.
_SAFE = re.compile(r"(?<=\S) (?=\S)")


def tokenizer_path(name: str = BYTE_BPE) -> str:
    """Where a public vocabulary file lies on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


class WordEncoder:
    """Ids of texts as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str, remembered: int = REMEMBERED, special: bool = False):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self._whole = Tokenizer.from_file(path)
        self._whole.encode_special_tokens = not special
        # Names that cut a text; white space before one is a pre-token of its own.
        added = self._whole.get_added_tokens_decoder().values() if special else []
        self._names = [t.content for t in added]
        before = "|".join([_RUN.pattern, *[rf"\s\s{re.escape(n)}" for n in self._names]])
        self._run = re.compile(before)
        self._remembered = remembered
        self._break = self.whole("\n")
        # Tokens that begin with a space, which byte-level vocabularies write as Ġ.
        vocabulary = self._whole.get_vocab()
        self._spaced = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self._spaced[[i for piece, i in vocabulary.items() if piece.startswith("Ġ")]] = True
        self._marks = {c: self.whole(c) for c in ".,"}
        self._young: dict[str, bytes] = {"": b"", "\n": self._break}
        self._old: dict[str, bytes] = {}

    def named(self, text: str) -> bool:
        """Whether a special token is in the text."""
        return any(n in text for n in self._names)

    def whole(self, text: str) -> bytes:
        """What the library gives for the text as it is."""
        found = self._whole.encode(text, add_special_tokens=False).ids
        return np.array(found, "<u4").tobytes()

    def count_few(self, texts: list[str]) -> list[int]:
        """Tokens of a handful of short texts, without the outlay of a batch."""
        found = list(map(self._young.get, texts))
        missing = [t for t, ids in zip(texts, found, strict=True) if ids is None]
        new = iter(self._whole.encode_batch_fast(missing, add_special_tokens=False) if missing else ())
        return [len(next(new).ids) if ids is None else len(ids) // 4 for ids in found]

    def encode(self, texts: pa.Array | list[str | None]) -> Iterator[bytes]:
        """Ids of each text, in order; a missing text has none."""
        column = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        column = column.fill_null("")
        sizes = np.cumsum(pc.utf8_length(column).to_numpy(zero_copy_only=False).astype(np.int64))
        begin = 0
        while begin < len(column):
            done = sizes[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(sizes, done + TOGETHER, "right")))
            if sizes[begin] - done > TOGETHER:
                yield self._long(column[begin].as_py())
                end = begin + 1
            else:
                yield from self._encode(column.slice(begin, end - begin))
            begin = end

    def _long(self, text: str) -> bytes:
        """A very long text in parts, cut where a pre-token surely begins."""
        parts, begin = [], 0
        while begin < len(text):
            cut = _SAFE.search(text, begin + TOGETHER // 2)
            end = cut.start() if cut else len(text)
            parts.extend(self._encode(pa.array([text[begin:end]])))
            begin = end
        return b"".join(parts)

    def _encode(self, column: pa.Array) -> list[bytes]:
        column, apart = self._apart(column)
        lists, every, which, known = self._words(column)
        lengths = np.fromiter(map(len, known), np.int64, len(known)) // 4
        flat = np.frombuffer(b"".join(known), "<u4")
        times = lengths[which]
        after = np.cumsum(times)
        shift = (np.cumsum(lengths) - lengths)[which] - (after - times)
        ids = flat[np.repeat(shift, times) + np.arange(after[-1] if len(after) else 0)]
        counts = np.cumsum(pc.list_value_length(lists).to_numpy())
        ends = np.concatenate([[0], after])[counts].tolist()
        found, begin = [], 0
        for i, end in enumerate(ends):
            found.append(self.whole(apart[i]) if i in apart else ids[begin:end].tobytes())
            begin = end
        return found

    def segments(self, column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray] | None]:
        """Characters and tokens of the words and line breaks of each text; None for a text
        that cannot be cut at all of its spaces and line breaks."""
        begin = 0
        sizes = np.cumsum(pc.utf8_length(column).to_numpy(zero_copy_only=False).astype(np.int64))
        while begin < len(column):
            done = sizes[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(sizes, done + TOGETHER, "right")))
            part, apart = self._apart(column.slice(begin, end - begin))
            lists, every, which, known = self._words(part)
            tokens = (np.fromiter(map(len, known), np.int32, len(known)) // 4)[which]
            chars = pc.utf8_length(every.dictionary).to_numpy(zero_copy_only=False)[which]
            real = chars > 0
            bounds = np.append(0, np.cumsum(pc.list_value_length(lists).to_numpy()))
            bounds = np.append(0, np.cumsum(real))[bounds].tolist()
            tokens, chars = tokens[real], chars[real]
            for i in range(len(part)):
                own = slice(bounds[i], bounds[i + 1])
                yield None if i in apart else (chars[own], tokens[own])
            begin = end

    def _apart(self, column: pa.Array) -> tuple[pa.Array, dict[int, str]]:
        """The texts that may be cut everywhere, and the others by place, empty in the column."""
        # Texts whose white space is single spaces and line breaks need no closer look.
        doubtful = pc.match_substring_regex(column, _DOUBT)
        apart = {}
        for i in np.flatnonzero(doubtful.to_numpy(zero_copy_only=False)).tolist():
            if self._run.search(text := column[i].as_py()):
                apart[i] = text
        if apart:
            keep = np.ones(len(column), bool)
            keep[list(apart)] = False
            column = pc.if_else(pa.array(keep), column, "")
        return column, apart

    def _words(self, column: pa.Array):
        """Words per text, the words as a dictionary, which of it each is, and their ids."""
        marked = pc.replace_substring(column, " ", "\0 ")
        lists = pc.split_pattern(pc.replace_substring(marked, "\n", "\0\n\0"), "\0")
        every = lists.flatten().dictionary_encode()
        which = every.indices.to_numpy()
        # By way of numpy, which makes the strings several times as fast as a list of scalars.
        words = every.dictionary.to_numpy(zero_copy_only=False).tolist()
        return lists, every, which, self._look_up(words)

    def _look_up(self, words: list[str]) -> list[bytes]:
        """Ids of distinct words, each with the space before it; remembers what is new."""
        found = list(map(self._young.get, words))
        if None in found:
            at = [i for i, ids in enumerate(found) if ids is None]
            new = [words[i] for i in at]
            self._remember(new)
            for i, ids in zip(at, map(self._young.__getitem__, new), strict=True):
                found[i] = ids
            if len(self._young) > self._remembered:
                self._young, self._old = {"": b"", "\n": self._break}, self._young
        return found

    def _remember(self, words: list[str]) -> None:
        young, ended, bare = self._young, [], []
        for w, ids in zip(words, map(self._old.get, words), strict=True):
            if ids is not None:
                young[w] = ids
            # A full stop or comma after a letter is a pre-token of its own.
            elif w[-1] in ".," and w[-2:-1].isalpha() and w[-2] <= "ÿ":
                ended.append(w)
            else:
                bare.append(w)
        stems = [w[:-1] for w in ended]
        self._learn([w for w in dict.fromkeys(bare + stems) if w not in young], young)
        for w, stem in zip(ended, stems, strict=True):
            young[w] = young[stem] + self._marks[w[-1]]

    def _learn(self, words: list[str], into: dict[str, bytes]) -> None:
        """Encode many words as one text and cut its ids where the next word begins."""
        joined = "".join(words)
        if " " in words or _INNER.search(joined) or self.named(joined):
            plain = []
            for w in words:
                bare = w[1:] if w[0] == " " else w
                if bare.split() == [bare] and not self.named(w):
                    plain.append(w)
                else:
                    into[w] = self.whole(w)
            words = plain
        self._many([w for w in words if w[0] == " "], "", into)
        self._many([w for w in words if w[0] != " "], "\n", into)

    def _many(self, words: list[str], between: str, into: dict[str, bytes]) -> None:
        """Words that all have a space before them may follow one another; the first token of
        each, and no other, begins with a space. Others need a line break between them."""
        line_break = int.from_bytes(self._break, "little")
        for at in range(0, len(words), LEARNED):
            part = words[at : at + LEARNED]
            found = self._whole.encode_batch_fast([between.join(part)], add_special_tokens=False)
            ids = np.array(found[0].ids, "<u4")
            if between:
                ends = np.append(np.flatnonzero(ids == line_break), len(ids)) * 4
                begins = np.append(0, ends[:-1] + 4)
            else:
                begins = np.flatnonzero(self._spaced[ids]) * 4
                ends = np.append(begins[1:], len(ids) * 4)
            raw = ids.tobytes()
            for w, begin, end in zip(part, begins.tolist(), ends.tolist(), strict=True):
                into[w] = raw[begin:end]


@lru_cache(maxsize=4)
def encoder(path: str, special: bool = False) -> WordEncoder:
    """One encoder per Python worker."""
    return WordEncoder(path, special=special)
