import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import simhash

SCHEMA = "doc_id bigint, text string, anchor string, row string"


def brute(texts):
    import xxhash

    found = []
    for text in texts:
        words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
                 .replace("\t", " ").replace("\n", " ").split(" ") if w]
        shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
        hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        found.append(sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)))
    return found


def classes(ids, prints, most=3):
    label = list(range(len(prints)))
    changed = True
    while changed:
        changed = False
        for i in range(len(prints)):
            for j in range(i):
                if (prints[i] ^ prints[j]).bit_count() <= most and label[i] != label[j]:
                    label[i] = label[j] = min(label[i], label[j])
                    changed = True
    least = {}
    for i, c in zip(ids, label, strict=True):
        if i is not None:
            least[c] = min(i, least.get(c, i))
    return [least.get(c) for c in label]


def test_the_code_is_perfect_and_its_radius_three():
    _, words, begin, counts = simhash._code(3)
    assert (counts[0] == 1).all()
    assert len(begin) == 2048 and counts[3].sum() == len(words)


@pytest.mark.parametrize("codes", [1, 2])
def test_close_fingerprints_meet_at_a_home(codes):
    draw = random.Random(3)
    for _ in range(300):
        x = draw.getrandbits(64)
        y = x
        for bit in draw.sample(range(64), draw.randint(0, 3)):
            y ^= 1 << bit
        index, anchor, cost = simhash.anchors(np.array([x, y], np.uint64), codes, 3)
        home = anchor[(index == 0) & (cost == 0)]
        assert len(home) == 1 and home[0] in anchor[index == 1]
        assert len(set(anchor[index == 1].tolist())) == (index == 1).sum()


def _texts():
    draw = random.Random(1)
    words = ["".join(draw.choices("abcdefgh", k=4)) for _ in range(300)]
    texts = [" ".join(draw.choices(words, k=draw.randint(30, 120))) for _ in range(40)]
    for base in texts[:12]:
        for _ in range(4):
            own = base.split()
            own[draw.randrange(len(own))] = "changed"
            texts.append(" ".join(own))
    return [*texts, *texts[:5], "", None, " \t\n", "one", "one two", "One TWO", "É é", "w " * 60_000]


@pytest.mark.parametrize("codes", [None, 2])
def test_near_duplicates_equal_brute_force(spark, codes, monkeypatch):
    if codes:
        monkeypatch.setattr(simhash, "ONE_CODE", 0)
    texts = _texts()
    ids = [*range(100, 100 + len(texts) - 1), None]
    rows = [(i, t, "x", "y") for i, t in zip(ids, texts, strict=True)]
    rows.append(rows[0])
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    prints = brute([r[1] for r in rows])
    want = sorted(zip([r[0] or 0 for r in rows], [f"{p:016x}" for p in prints],
                      classes([r[0] for r in rows], prints), strict=True))
    got = simhash.near_duplicates(docs).fillna(0, "doc_id").collect()
    assert sorted((r.doc_id, r.fingerprint, r.component_id) for r in got) == want


def test_pieces_of_an_anchor_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(simhash, "HOMES", 5)
    draw = random.Random(5)
    base = draw.getrandbits(63)
    prints = sorted({base ^ 1 << a ^ 1 << b for a in range(0, 60, 3) for b in range(0, 60, 7)})
    fps = spark.createDataFrame([(p,) for p in prints], "fingerprint bigint")
    found = simhash.links(fps).collect()
    assert len(found) < 71 * 2 * len(prints) * 30
    label = {p: p for p in prints}

    def root(p):
        while label[p] != p:
            p = label[p]
        return p

    for a, b in found:
        label[root(a)] = root(b)
    assert len({root(p) for p in prints}) == len(set(classes(prints, prints)))


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert simhash.near_duplicates(empty).count() == 0
    assert simhash.fingerprints(empty.withColumn("doc_id", F.lit(1))).count() == 0


def test_one_row_of_each_component_stays(spark, monkeypatch):
    prints = {"a": 0, "a'": 1, "b": 0xFFFF << 8, "b'": 0xFFFE << 8, "c": 0xFFFF << 40, "d": -1}
    kinds = spark.createDataFrame(list(prints.items()), "text string, fingerprint bigint")
    monkeypatch.setattr(
        simhash, "fingerprints",
        lambda docs: docs.join(F.broadcast(kinds), "text").select("doc_id", "fingerprint"),
    )
    rows = [
        (1, "a", "x"), (None, "a", "x"), (None, "a'", "x"),  # a component with an id
        (None, "b", "x"), (None, "b'", "y"), (None, "b", "z"),  # one without
        (5, "c", "x"), (5, "c", "y"), (5, "a'", "x"),  # an id that is the least of one alone
        (7, "d", "x"),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, `odd.name` string")
    found = simhash.kept(docs)
    assert found.columns == docs.columns
    got = [tuple(r) for r in found.collect()]
    assert set(got) <= set(rows)
    assert sorted((str(i), t[0]) for i, t, _ in got) == [("1", "a"), ("5", "c"), ("7", "d"), ("None", "b")]
