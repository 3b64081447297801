"""Plain measures of a text that rules and classifiers share.

Words are runs of other characters than the six of ASCII white space. All counts are over
the whole text; a missing text has none of anything.
"""

from __future__ import annotations

import re

import numpy as np

# The characters that count as symbols.
SYMBOLS = b"#*$%&|<>"
_NOT_SYMBOL = bytes(b for b in range(256) if b not in SYMBOLS)
_ODD = SYMBOLS + b"!"
_UPPER = bytes(b for b in range(256) if not 65 <= b <= 90)
_LOWER = bytes(b for b in range(256) if not 97 <= b <= 122)
_DIGITS = bytes(b for b in range(256) if not 48 <= b <= 57)
_NO_LEAD = bytes(b for b in range(256) if 0x80 <= b < 0xC0)
_SPACE = b" \t\n\x0b\x0c\r"
_STOP = re.compile(rb"[.!?]")

COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_distinct", "n_common", "n_upper", "n_lower", "n_digits", "n_bangs", "n_bars",
    "n_stops", "longest_word", "n_same_pair", "dup_line_chars", "n_odd_words",
)


def counts(text: str | None) -> tuple[int, ...]:
    """The measures named in ``COUNTS``."""
    raw = (text or "").encode("utf-8", "replace")
    words = raw.split()
    n = len(words)
    if not n:
        symbols = len(raw.translate(None, _NOT_SYMBOL))
        return (0, 0, symbols, *[0] * (len(COUNTS) - 3))
    dense = raw.translate(None, _SPACE)
    chars = len(dense.translate(None, _NO_LEAD))
    symbols = len(dense.translate(None, _NOT_SYMBOL))
    upper = len(dense.translate(None, _UPPER))
    lower = len(dense.translate(None, _LOWER))
    digits = len(dense.translate(None, _DIGITS))
    lines = [line for line in raw.split(b"\n") if line.strip()]
    seen: set[bytes] = set()
    repeated = 0
    repeated_chars = 0
    for line in lines:
        if line in seen:
            repeated += 1
            repeated_chars += len(line)
        seen.add(line)
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    often = np.bincount(ids)
    odd = sum(often[i] for w, i in number.items() if w[-1] in _ODD or w[0] in _ODD)
    return (
        n, chars, symbols, repeated, _repeated_words(ids, len(number)),
        len(lines), len(number), int(often.max()), upper, lower, digits,
        raw.count(b"!"), raw.count(b"|"), len(_STOP.findall(raw)), max(map(len, number)),
        int((ids[1:] == ids[:-1]).sum()), repeated_chars, int(odd),
    )


def _repeated_words(ids: np.ndarray, distinct: int) -> int:
    """Words within three-word windows that the text has twice or more."""
    n = len(ids)
    if n < 4:
        return 0
    # Distinct pairs numbered first, so that no product passes 64 bits.
    _, pair = np.unique(ids[:-1] * distinct + ids[1:], return_inverse=True)
    _, which, times = np.unique(pair[:-1] * np.int64(distinct) + ids[2:], return_inverse=True, return_counts=True)
    again = times[which] > 1
    covered = np.zeros(n, bool)
    for shift in range(3):
        covered[shift : n - 2 + shift] |= again
    return int(covered.sum())
