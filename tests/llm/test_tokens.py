import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import packing, pfor, tokenfile, vocab

SCHEMA = "doc_id bigint, text string, part string, ids string, row string"


@pytest.fixture(scope="module")
def whole():
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def _rows():
    draw = random.Random(7)
    texts = ["", None, "a", " a  b ", "x\n\n\ny \n", "<|endoftext|>", "word " * 40_000, "é ñ 😀", "a", "a"]
    texts += ["".join(draw.choices("abc .,\n", k=draw.randint(1, 9_000))) for _ in range(40)]
    rows = [(i, t, "p", "q", "r") for i, t in enumerate(texts)]
    draw.shuffle(rows)
    return [*rows, rows[0], (None, "no id", "", "", "")]


def test_words_and_whole_texts_give_the_same_ids(whole):
    draw = random.Random(1)
    parts = [" ", "\n", "a", "'s", "don't", "\t", "1", "!", ".", ",", "\x1c", "\xa0", "é.", " ", "\r", "\x85", "ab"]
    texts = ["".join(draw.choices(parts, [6, 4, 6] + [1] * 14, k=draw.randint(0, 12))) for _ in range(20_000)]
    found = vocab.WordEncoder(vocab.tokenizer_path(), remembered=50).encode(texts)
    for text, ids in zip(texts, found, strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == whole(text), repr(text)


@pytest.mark.parametrize("top", [1, 2, 200, 50_257, 2**32])
def test_blocks_round_trip(top):
    draw = np.random.default_rng(top)
    for n in (0, 1, 127, 128, 129, 5_000):
        ids = draw.integers(0, top, n, np.uint64).astype("<u4")
        ids[::37] = top - 1
        raw, begin = pfor.encode(ids)
        assert (pfor.decode(np.frombuffer(raw, np.uint8), begin, n) == ids).all()
        if n > 300:
            some = begin[1:3]
            part = pfor.decode(np.frombuffer(raw, np.uint8), some, 200)
            assert (part == ids[128:328]).all()


def test_outliers_do_not_widen_a_block():
    ids = np.arange(128, dtype="<u4") % 16
    plain = len(pfor.encode(ids)[0])
    ids[5] = 2**31
    assert len(pfor.encode(ids)[0]) == plain + 5


def test_files_end_with_the_document_that_fills_them(spark, tmp_path):
    docs = spark.createDataFrame(_rows(), SCHEMA).repartition(3)
    plain = tokenfile.write_tokens(docs, f"file://{tmp_path}/plain")
    want = tokenfile.read_tokens(spark, plain).orderBy("start").collect()
    for bound in ({"file_docs": 1}, {"file_ids": 40}):
        files = tokenfile.write_tokens(docs, f"file://{tmp_path}/{next(iter(bound))}", **bound)
        assert files.count() > plain.count()
        if "file_docs" in bound:
            assert files.count() == len(want)
        assert tokenfile.read_tokens(spark, files).orderBy("start").collect() == want


def test_files_give_the_documents_back(spark, whole, tmp_path, monkeypatch):
    monkeypatch.setattr(tokenfile, "AT_ONCE", 128 * 8)
    rows = _rows()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    files = tokenfile.write_tokens(docs, f"file://{tmp_path}/out")
    got = tokenfile.read_tokens(spark, files).orderBy("start").collect()
    assert [r.doc_id for r in got] == sorted((r[0] for r in rows), key=lambda i: (i is not None, i))
    texts, at = {r[0]: r[1] for r in rows}, 0
    for r in got:
        want = [*whole(texts[r.doc_id]), 2]
        assert r.start == at and np.frombuffer(r.ids, "<u4").tolist() == want
        at += len(want)


def test_plan_is_shortest_pack_first():
    draw = random.Random(3)
    for _ in range(200):
        lengths = [draw.randint(1, 40) for _ in range(draw.randint(1, 60))]
        packs = []
        for length in sorted(lengths, reverse=True):
            best = min(packs, key=sum, default=None)
            if best is not None and sum(best) + length <= 40:
                best.append(length)
            else:
                packs.append([length])
        histogram = {n: lengths.count(n) for n in lengths}
        found = packing.plan(histogram, 40)
        assert sorted(sum(p) for p in packs) == sorted(sum(p) for p, c in found for _ in range(c))
        assert sorted(x for p, c in found for x in p * c) == sorted(lengths)
        assert len(found) <= 3 * len(histogram)


def test_packed_pieces_hold_every_id_once(spark, whole):
    rows = _rows()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    pieces = packing.packed(packing.tokenized_pieces(docs)).cache()
    total = 0
    for rid, text in {(r[0], r[1]) for r in rows}:
        want = [*whole(text), 0]
        own = pieces.filter(F.col("doc_id").eqNullSafe(rid)).orderBy("start").collect()
        copies = sum(r[0] == rid for r in rows)
        assert len(own) == copies * len(packing.cuts(len(want), 1024))
        if copies == 1:
            assert [x for p in own for x in np.frombuffer(p.ids, "<u4").tolist()] == want
            assert [p.start for p in own] == np.cumsum([0, *[p.length for p in own]])[:-1].tolist()
            assert {p.doc_tokens for p in own} == {len(want)}
        total += copies * len(want)
    held = {}
    for p in pieces.collect():
        held.setdefault(p.sequence_id, []).append((p.offset, p.length))
    assert sorted(held) == list(range(len(held)))
    for parts in held.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    assert sum(n for parts in held.values() for _, n in parts) == total
    whole_rows = packing.sequences(pieces).collect()
    assert sum(len(r.ids) // 4 for r in whole_rows) == total
    pieces.unpersist()


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert packing.packed(packing.tokenized_pieces(empty)).count() == 0
    assert tokenfile.read_tokens(spark, tokenfile.write_tokens(empty)).count() == 0


def test_digest_is_that_of_the_ids(spark):
    docs = spark.createDataFrame([(1, "some words")], "doc_id bigint, text string")
    row = packing.tokenized_pieces(docs).select("ids", F.crc32("ids").alias("c")).first()
    assert row.c == zlib.crc32(bytes(row.ids))
