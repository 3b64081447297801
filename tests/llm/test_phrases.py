"""Spelling variants, substring dedup and collocations against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import collocations, passages, spelling

SCHEMA = "doc_id bigint, text string, lang string, word string, slice string, chunk string"


def _docs(spark, rows, parts=3):
    return spark.createDataFrame([(*r, "w", "s", "c") for r in rows], SCHEMA).repartition(parts)


def _given(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return docs, [(r.doc_id, r.text, r.lang) for r in docs.select("doc_id", "text", "lang").collect()]


# --- Spelling variants ----------------------------------------------------------------------


def one_edit(u, v):
    if len(u) > len(v):
        u, v = v, u
    if u == v or len(v) - len(u) > 1:
        return False
    p = 0
    while p < len(u) and u[p] == v[p]:
        p += 1
    return u[p + 1 :] == v[p + 1 :] if len(u) == len(v) else u[p:] == v[p + 1 :]


def _variants(rows):
    counts = Counter()
    for doc_id, text, _ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    near = defaultdict(list)
    by_length = defaultdict(list)
    for w in words:
        by_length[len(w)].append(w)
    for size, these in by_length.items():
        others = by_length.get(size + 1, [])
        for u, v in [*combinations(these, 2), *((u, v) for u in these for v in others)]:
            if one_edit(u, v):
                near[u].append(v)
                near[v].append(u)
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best and words[best] >= 10 * n else None
    want = set()
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        want.add((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return want


def _got_variants(docs, most=spelling.MOST):
    rows = spelling.variants(docs, most).select("word", "form", "root", "n", "n_near", "form_n").collect()
    assert len(rows) == len({r.word for r in rows})
    return set(map(tuple, rows))


def _misspelt(draw):
    base = ["".join(draw.choices("abcé", k=draw.randint(6, 12))) for _ in range(40)]
    rows = []
    for i in range(120):
        words = []
        for w in draw.choices(base, weights=[3**-(k % 7) for k in range(40)], k=60):
            at = draw.randrange(len(w))
            kind = draw.random()
            if kind < 0.05:
                w = w[:at] + draw.choice("abcé") + w[at + 1 :]
            elif kind < 0.1:
                w = w[:at] + draw.choice("abcé") + w[at:]
            words.append(w.capitalize() if draw.random() < 0.2 else w)
        rows.append((i, draw.choice([" ", "-", "1"]).join(words), None))
    return rows


def test_variants_equal_brute_force(spark):
    draw = random.Random(11)
    giant = "ab" * 2_000
    rows = _misspelt(draw) + [
        (500, None, None), (501, "", None), (None, "abcabcabc abcabcabc", None), (None, "abcabcabc", None),
        (502, f"{giant} {giant}x {giant}", None), (503, f"{giant}x ÿ×÷ÀÉÿ×÷ ÿ×÷ÀÉÿ×÷", None), (3, "abcabcabc", None),
        # A chain of three forms.
        (600, "chainaaa " * 3, None), (601, "chainaab " * 40, None), (602, "chainabb " * 500, None),
        (603, "chainbbb " * 5000, None),
    ]
    docs = _docs(spark, rows)
    want = _variants(rows)
    assert sum(w[1] is not None for w in want) > 10 and sum(w[2] not in (w[0], w[1]) for w in want) > 0
    assert _got_variants(docs) == want
    # Blocks that must be dealt again give the same pairs.
    assert _got_variants(docs, most=3) == want


def test_variants_of_the_given_table(spark, sf_dir):
    docs, rows = _given(spark, sf_dir)
    assert _got_variants(docs) == _variants(rows)


def test_scan_of_blocks_equals_brute_force():
    draw = random.Random(1)
    for _ in range(200):
        letters = draw.choice(["ab", "abc", "abcdefghé", "aÿ"])
        blocks = []
        for _ in range(draw.randint(1, 4)):
            prefix = "".join(draw.choices(letters, k=draw.randint(0, 4)))
            ends = ["".join(draw.choices(letters, k=draw.randint(0, 6))) for _ in range(draw.randint(1, 40))]
            blocks.append(sorted({prefix + e or "a" for e in ends}))
        words = [w for block in blocks for w in block]
        block = np.concatenate([np.full(len(b), k) for k, b in enumerate(blocks)])
        _, i, j = spelling.near_pairs(words, block)
        want = [
            (a, b) for a, b in combinations(range(len(words)), 2) if block[a] == block[b] and one_edit(words[a], words[b])
        ]
        assert sorted((min(p), max(p)) for p in zip(i.tolist(), j.tolist())) == want


def test_scan_of_very_long_words():
    words = sorted(["a" * 3000, "a" * 3001, "a" * 2999 + "b", "a" * 1000 + "c" + "a" * 1999, "a" * 300 + "zz" + "a" * 3000])
    _, i, j = spelling.near_pairs(words, np.zeros(5))
    want = [(a, b) for a, b in combinations(range(5), 2) if one_edit(words[a], words[b])]
    assert sorted((min(p), max(p)) for p in zip(i.tolist(), j.tolist())) == want


# --- Substring dedup ------------------------------------------------------------------------


def _removed(rows):
    """Rows alike in id and text are one document; ids that are missing come last."""
    docs = sorted({(i, t or "") for i, t, _ in rows}, key=lambda d: (d[0] is None, d[0] or 0, d[1].encode()))
    seen, result = set(), {}
    for doc in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", doc[1])
        gone = [False] * len(words)
        for at in range(len(words) - 19):
            window = tuple(words[at : at + 20])
            if window in seen:
                gone[at : at + 20] = [True] * 20
            seen.add(window)
        kept = " ".join(w for w, out in zip(words, gone) if not out)
        result[doc] = (len(words), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
    return sorted((str(i), *result[i, t or ""]) for i, t, _ in rows)


def _got_removed(docs, **options):
    rows = passages.deduplicated(docs, **options)
    assert rows.columns == ["doc_id", "n_words", "n_removed", "kept_sha256"]
    return sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in rows.collect())


def _with_passages(draw, many=80):
    letters = ["a", "b", "ab", "é", "c c", "d.", "x" * 5000]
    shared = [" ".join(draw.choices(letters[:3] if k % 2 else letters, k=draw.randint(20, 60))) for k in range(6)]
    rows = []
    for i in range(many):
        parts = []
        for _ in range(draw.randint(0, 4)):
            words = [f"{draw.choice(letters)}{draw.randrange(2000)}" for _ in range(draw.randint(0, 40))]
            parts += [draw.choice([" ", "\n", "\t \x0b"]).join(words)]
            if draw.random() < 0.4:
                passage = draw.choice(shared).split(" ")
                a = draw.randrange(0, len(passage) - 10)
                parts += [" ".join(passage[a : draw.randint(a + 5, len(passage))])]
        rows.append((i * 7 % 101, " ".join(parts), "en"))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_removed_equal_brute_force(spark, seed):
    draw = random.Random(seed)
    rows = _with_passages(draw)
    same = " ".join(f"w{k}" for k in range(50))
    rows += [
        (900, None, None), (901, "", "x"), (902, "a " * 21, "x"), (903, "a " * 200, "x"), (904, "a b c " * 30, "x"),
        (910, same, "x"), (911, same, "x"), (911, same, "x"), (912, same.replace(" ", "\n"), "x"), (None, same, "x"),
        (None, same, "x"), (None, same + " more", "x"), (913, "short text", "x"), (914, "short text", "x"),
        (915, "x" * 9000 + " " + same, "x"), (915, "y" * 9000 + " " + same, "x"),
    ]
    docs = _docs(spark, rows)
    want = _removed(rows)
    assert _got_removed(docs) == want


def test_removed_over_many_slices(spark):
    draw = random.Random(5)
    rows = _with_passages(draw, 150)
    rows = [(n, t, g) for n, (_, t, g) in enumerate(rows)] + [(500 + n, rows[n][1], "x") for n in range(30)]
    assert _got_removed(_docs(spark, rows, 5), size=3000) == _removed(rows)


def test_removed_of_the_given_table(spark, sf_dir):
    docs, rows = _given(spark, sf_dir)
    want = _removed(rows)
    assert sum(n > 0 for _, _, n, _ in want) > 0
    assert _got_removed(docs, size=100_000) == want


def test_automata_in_shards_find_all():
    draw = random.Random(3)
    numbers = np.array(draw.choices([0, 1, 2, 3], weights=[1, 30, 30, 3], k=3000), np.int64)
    windows = {}
    for at in range(len(numbers) - 19):
        if (numbers[at : at + 20] > 0).all():
            windows.setdefault(numbers[at : at + 20].tobytes(), []).append(at)
    firsts = np.array([places[0] for places in windows.values()])
    want = sorted((at, places[0]) for places in windows.values() for at in places)
    for shard in (7, 1000):
        found = [pair for at, start in passages.located(numbers, firsts, shard) for pair in zip(at, start)]
        assert sorted(found) == want


@pytest.mark.parametrize("phrase", [1, 2, 4, 5, 10, 20])
def test_phrases_of_any_length_are_told_apart(phrase, monkeypatch):
    monkeypatch.setattr(passages, "PHRASE", phrase)
    draw = random.Random(phrase)
    numbers = np.array(draw.choices([0, 1, 2], k=500), np.int64)
    found = passages._phrases(numbers)
    runs = [tuple(numbers[at : at + phrase]) for at in range(len(numbers) - phrase + 1)]
    assert len(found) == len(runs) and found.min() >= 1
    assert len(set(zip(runs, found.tolist()))) == len(set(runs)) == len(set(found.tolist()))


# --- Collocations ---------------------------------------------------------------------------


def _collocations(rows, least, top):
    f, n = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in range(1, 5):
                for at in range(len(words) - size + 1):
                    f[lang][tuple(words[at : at + size])] += 1
    result = set()
    for lang, counts in f.items():
        some = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        around = Counter()
        for p, a in some.items():
            for size in range(2, len(p)):
                for at in range(len(p) - size + 1):
                    around[p[at : at + size]] = max(around[p[at : at + size]], a)
        ranked = []
        for p, a in some.items():
            if 100 * around[p] >= 80 * a:
                continue
            cuts = [(2000000 * a // (counts[p[:k]] + counts[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            ranked.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(ranked)[:top], 1):
            result.add((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return result


def _got_collocations(docs, least, top, **options):
    rows = collocations.collocations(docs, least, top=top, **options)
    return set(map(tuple, rows.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()))


def _phrases(draw, many):
    rows = []
    for i in range(many):
        words = draw.choices(["A", "b", "c", "dé", "new york city", "New  York\tCity hall", "e e", "#"], k=draw.randint(0, 60))
        text = "".join(w + draw.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\r\n", "\x0b"]) for w in words)
        rows.append((i, text, draw.choice(["en", "en", "en", "fr", None, ""])))
    return rows


@pytest.mark.parametrize("size", [collocations.CHUNK, 400])
def test_collocations_equal_brute_force(spark, size):
    draw = random.Random(4)
    rows = _phrases(draw, 150) + [(1, None, None), (1, "", "en"), (None, "a b c . . .", "xx"), (None, "...", "yy")]
    rows += [rows[3]] * 3
    for least, top in ((5, 2000), (30, 7)):
        want = _collocations(rows, least, top)
        assert len(want) > 10
        assert _got_collocations(_docs(spark, rows), least, top, size=size) == want


def test_collocations_of_the_given_table(spark, sf_dir):
    docs, rows = _given(spark, sf_dir)
    want = _collocations(rows, 10, 2000)
    assert len(want) > 100
    assert _got_collocations(docs, 10, 2000, size=200_000) == want


def test_scores_are_exact(spark):
    big = 9_000_000_000_000
    phrases = spark.createDataFrame(
        [("en", "a", 1, big + 1), ("en", "b", 1, big + 2), ("en", "a b", 2, big - 1)],
        "lang string, phrase string, size int, a bigint",
    )
    totals = spark.createDataFrame([("en", 3 * big)], "lang string, n bigint")
    row = collocations.scored(phrases, totals).first()
    assert row.score == 2000000 * (big - 1) // (2 * big + 3)


def test_empty_tables(spark):
    docs = _docs(spark, []).filter(F.lit(False))
    assert spelling.variants(docs).collect() == []
    assert passages.deduplicated(docs).collect() == []
    assert collocations.collocations(docs).collect() == []
    nothing = _docs(spark, [(1, None, None), (2, "", "en")])
    assert spelling.variants(nothing).collect() == []
    assert collocations.collocations(nothing).collect() == []
    assert len(passages.deduplicated(nothing).collect()) == 2
