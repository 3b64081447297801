"""Names of special tokens in texts: the queries give the ids of the library's own default."""

import random
import zlib

import numpy as np
import pytest

import corpus_pipeline
from millrace.llm import edits, queries, vocab

NAME = "<|endoftext|>"


@pytest.fixture(scope="module")
def default():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(vocab.tokenizer_path())
    return lambda text: t.encode(text, add_special_tokens=False).ids


def _text(draw, most):
    parts = [" ", "\n", "a", NAME, "'s", "\t", ".", ",", "\x1c", "\xa0", "<|endof", "text|>", "é."]
    return "".join(draw.choices(parts, [6, 4, 6, 4] + [1] * 9, k=draw.randint(0, most)))


def test_words_and_whole_texts_give_the_default_ids(default):
    assert default(f"a {NAME} b") == [64, 220, 50256, 275]
    draw = random.Random(1)
    texts = [_text(draw, 12) for _ in range(20_000)]
    found = vocab.WordEncoder(vocab.tokenizer_path(), remembered=50, special=True).encode(texts)
    for text, ids in zip(texts, found, strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == default(text), repr(text)


def test_edits_that_make_and_break_names(default, monkeypatch):
    monkeypatch.setattr(edits, "BLOCK", 3)
    draw = random.Random(2)
    path = vocab.tokenizer_path()
    count = edits.Counter(path, special=True)
    for _ in range(1_500):
        text = _text(draw, 40)
        (leaves,) = edits._leaves(edits.pa.array([text]), path, True)
        assert sum(leaves[1]) == len(default(text))
        parts = edits.segments(text)
        tree = edits.Tree(text, list(map(len, parts)), count(parts))
        for _ in range(6):
            start, removed, new = draw.randint(-2, len(text) + 3), draw.randint(0, 12), _text(draw, 5)
            tree.edit(start, removed, new, count)
            at = min(max(0, start), len(text))
            text = text[:at] + new + text[at + removed :]
            assert tree.text() == text
            assert tree.n_tokens == len(default(text)), repr(text)
    # The line breaks before are segments of their own.
    (leaves,) = edits._leaves(edits.pa.array(["x\n\n<|endof|> y"]), path, True)
    tree = edits.Tree("x\n\n<|endof|> y", *leaves)
    tree.edit(10, 0, "text", count)
    assert tree.text() == f"x\n\n{NAME} y" and tree.n_tokens == len(default(tree.text()))


def test_queries_give_the_default_ids(spark, default, tmp_path):
    texts = [f"a {NAME} b", "plain", f"x\n\n{NAME}", f"{NAME}{NAME}."]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    at = 0
    for r in queries.op7_token_files(spark, str(tmp_path)).orderBy("doc_id").collect():
        ids = [*default(texts[r.doc_id]), 2]
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    packed = [queries.op2_packing(spark, str(tmp_path)), corpus_pipeline.sequences(spark, docs, str(tmp_path))]
    for rows in packed:
        for r in rows.collect():
            ids = [*default(texts[r.doc_id]), 0]
            assert (r.length, r.ids_crc32) == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
    for r in queries.op1_edit_counts(spark, str(tmp_path)).collect():
        assert r.n_tokens == len(default(texts[r.doc_id]))
