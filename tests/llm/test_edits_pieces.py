import random
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from millrace.llm import edits, pieces, vocab

SCHEMA = "doc_id bigint, text string, part string, ids string, row string"
ODD = [" ", "  ", "\n", "a", "bc", "▁", "é", "😀", ".", "\t", "漢", "the", " the", " ", "<0x41>"]


@pytest.fixture(scope="module")
def whole():
    return vocab.WordEncoder(vocab.tokenizer_path()).whole


def _text(draw, most):
    return "".join(draw.choices(ODD, [9, 1, 2, 6, 6] + [1] * 10, k=draw.randint(0, most)))


def test_edited_counts_equal_whole_encoding(whole, monkeypatch):
    monkeypatch.setattr(edits, "BLOCK", 3)
    draw = random.Random(1)
    count = edits.Counter(vocab.tokenizer_path())
    for _ in range(400):
        text = _text(draw, 80)
        parts = edits.segments(text)
        assert "".join(parts) == text
        tree = edits.Tree(text, list(map(len, parts)), count(parts))
        for _ in range(6):
            start, removed, new = draw.randint(-2, len(text) + 3), draw.randint(0, 12), _text(draw, 9)
            tree.edit(start, removed, new, count)
            at = min(max(0, start), len(text))
            text = text[:at] + new + text[at + removed :]
            assert tree.text() == text
            assert tree.n_tokens == len(whole(text)) // 4, repr(text)
            own, tokens = tree.parts()
            assert sum(tokens) == tree.n_tokens and sum(own) == tree.chars[1] == len(text)


SPACES = ["\n", "\n\n", "\t", "\xa0", " ", "  ", "\u2003", "\r\n"]


def test_trees_as_tables_have_them_stay_right_at_white_space(whole, monkeypatch):
    """Leaves cut at every line break; edits beside blank lines, tabs and odd spaces."""
    monkeypatch.setattr(edits, "BLOCK", 3)
    draw = random.Random(9)
    path = vocab.tokenizer_path()
    count = edits.counter(path)
    plain = ["x", "One", ".", "Two", "words", "here", ",", "é", "12"]

    def text_of(most):
        return "".join(draw.choices([" ", "\n", "\n\n", *SPACES, *plain], [9, 5, 5] + [1] * 8 + [3] * 9, k=draw.randint(0, most)))

    texts = ["x.\n\ny", "One.\n\nTwo words here", "a b\n\nc d", "\n\n\n", *[text_of(40) for _ in range(1500)]]
    for text, (chars, tokens) in zip(texts, edits._leaves(pa.array(texts), path, False), strict=True):
        tree = edits.Tree(text, chars, tokens)
        assert tree.n_tokens == len(whole(text)) // 4, repr(text)
        for _ in range(4):
            start, removed = draw.randint(0, len(text)), draw.choice([0, 1, 1, 2, 7])
            new = draw.choice(["", "", text_of(3), draw.choice(SPACES)])
            tree.edit(start, removed, new, count)
            text = text[:start] + new + text[start + removed :]
            assert tree.text() == text and tree.n_tokens == len(whole(text)) // 4, repr(text)


def test_a_second_round_starts_from_stored_trees(spark, whole, tmp_path):
    texts = ["Some words.\n\nA second paragraph here, and more. " * k for k in range(1, 30)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    edits.built(docs).write.parquet(f"{tmp_path}/trees")
    trees = spark.read.parquet(f"{tmp_path}/trees")
    edits.edited(edits.drawn_edits(trees)).write.parquet(f"{tmp_path}/once")
    # The trees of the first round, with edits drawn anew from what it left.
    again = edits.drawn_edits(spark.read.parquet(f"{tmp_path}/once"))
    changes = {r.doc_id: (r.text, r.edits) for r in again.collect()}
    for r in edits.edited(again).collect():
        text, drawn = changes[r.doc_id]
        assert r.n_tokens == len(whole(text)) // 4
        for c in drawn:
            at = min(c.start, len(text))
            text = text[:at] + c.inserted + text[at + c.removed :]
        assert r.text == text and r.edited_tokens == len(whole(text)) // 4


def test_an_edit_encodes_few_segments():
    count = edits.Counter(vocab.tokenizer_path())
    parts = edits.segments("some words here " * 20_000)
    tree = edits.Tree("".join(parts), list(map(len, parts)), count(parts))
    tree.edit(100_000, 5, "new words", count)
    assert tree.encoded < 10


def test_edits_over_a_table(spark, whole):
    draw = random.Random(2)
    rows = [(i, _text(draw, 300), "", "", "") for i in range(60)]
    rows += [(60, None, "", "", ""), (61, "", "", "", ""), (None, "x y", "", "", ""), rows[3]]
    docs = edits.drawn_edits(spark.createDataFrame(rows, SCHEMA)).repartition(3)
    for r in edits.edited(edits.built(docs)).collect():
        assert r.edited_tokens == len(whole(r.text)) // 4
        assert sum(r.segment_chars) == len(r.text) and sum(r.segment_tokens) == r.edited_tokens
    want = {r.doc_id: (r.text, r.edits) for r in docs.collect()}
    for r in edits.edited(edits.built(docs)).collect():
        text, changes = want[r.doc_id]
        assert r.n_tokens == len(whole(text)) // 4
        for c in changes:
            at = min(c.start, len(text))
            text = text[:at] + c.inserted + text[at + c.removed :]
        assert r.text == text
    plain = {r.doc_id: (r.text, r.edited_tokens) for r in edits.edited(docs).collect()}
    assert plain == {r.doc_id: (r.text, r.edited_tokens) for r in edits.edited(edits.built(docs)).collect()}
    missing = docs.withColumn("edits", F.lit(None).cast(edits.EDITS))
    assert all(r.n_tokens == r.edited_tokens for r in edits.edited(edits.built(missing)).collect())


def test_sampling_follows_the_weights():
    vocabulary = pieces.vocabulary(vocab.tokenizer_path(pieces.MODEL))

    def ways(word):
        if not word:
            yield (), 1.0
        for n in range(1, len(word) + 1):
            if word[:n] in vocabulary.ids:
                i = vocabulary.ids[word[:n]]
                for rest, weight in ways(word[n:]):
                    yield (i, *rest), np.exp(vocabulary.log_weights[i]) * weight

    known = dict(ways("▁that"))
    total = sum(known.values())
    sampler = pieces.Sampler(vocabulary)
    n = 40_000
    found = sampler.sample(["that"] * n, [pieces.seed_of(k) for k in range(n)])
    seen = {}
    for ids in found:
        way = tuple(np.frombuffer(ids, "<u4").tolist())
        seen[way] = seen.get(way, 0) + 1
    assert set(seen) <= set(known)
    for way, weight in known.items():
        share = weight / total
        assert abs(seen.get(way, 0) / n - share) < 5 * (share * (1 - share) / n) ** 0.5 + 1e-9


def test_decoding_is_lossless_and_sampling_repeats(spark):
    draw = random.Random(3)
    rows = [(i, _text(draw, 200), "", "", "") for i in range(80)]
    rows += [(90, None, "", "", ""), (91, "", "", "", ""), (None, "▁ ▁▁", "", "", ""), rows[5],
             (92, " lead", "", "", ""), (93, "x" * 5_000 + "漢" * 3_000, "", "", ""), (94, "   ", "", "", "")]
    docs = spark.createDataFrame(rows, SCHEMA)
    back = pieces.decoded(pieces.sampled(docs.repartition(3))).collect()
    texts = {r[0]: r[1] or "" for r in rows}
    assert len(back) == len(rows)
    for r in back:
        assert r.decoded == texts[r.doc_id]
        assert r.text_crc32 == zlib.crc32(texts[r.doc_id].encode())
    again = {r.doc_id: bytes(r.ids) for r in pieces.sampled(docs.repartition(7)).collect()}
    assert again == {r.doc_id: bytes(r.ids) for r in back}


def test_rows_differ_by_key():
    sampler = pieces.Sampler(pieces.vocabulary(vocab.tokenizer_path(pieces.MODEL)))
    text = "several words that may be cut in many ways"
    a, b = sampler.sample([text, text], [pieces.seed_of(1), pieces.seed_of(2)])
    assert a != b
    assert [a, b] == [sampler.sample([text], [pieces.seed_of(k)])[0] for k in (1, 2)]


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert pieces.decoded(pieces.sampled(empty)).count() == 0
    assert edits.edited(edits.built(edits.drawn_edits(empty))).count() == 0


def test_long_words_keep_their_shares():
    vocabulary = pieces.vocabulary(vocab.tokenizer_path(pieces.MODEL))
    span, piece, lifted, last = pieces.lattice(["▁" + "漢字" * 3_000, "", "▁that", "\ufdd0" * 900], vocabulary)
    assert np.isfinite(lifted).all() and (np.diff(lifted) >= 0).all()
    # The shares into every place end at one.
    assert np.allclose(lifted[last - 1], np.arange(len(last)) + 1)


def test_draws_do_not_depend_on_the_batch():
    vocabulary = pieces.vocabulary(vocab.tokenizer_path(pieces.MODEL))
    draw = random.Random(5)
    texts = ["".join(draw.choices("abe nt漢字\ufdd0é", k=draw.randrange(60))) for _ in range(400)]
    sampler, seeds = pieces.Sampler(vocabulary), list(range(400))
    together = sampler.sample(texts, seeds)
    assert together == [sampler.sample([t], [k])[0] for t, k in zip(texts, seeds)]
    lifted = pieces.lattice(texts, vocabulary)[2] * pieces.FINE
    assert (lifted == np.floor(lifted)).all()


def test_a_word_of_a_million_characters():
    vocabulary = pieces.vocabulary(vocab.tokenizer_path(pieces.MODEL))
    draw = random.Random(6)
    text = "".join(map(chr, draw.choices(range(0x4E00, 0x9000), k=1_000_000)))
    began = time.process_time()
    found = pieces.Sampler(vocabulary).sample([text], [1])
    assert time.process_time() - began < 10
    assert vocabulary.decode(pa.array(found, pa.binary())).to_pylist() == [text]


def test_marks_and_marks_for_marks_come_back():
    vocabulary = pieces.vocabulary(vocab.tokenizer_path(pieces.MODEL))
    texts = ["▁", " ▁ ", "\ufdd0▁\ufdd1 \0", "", "a  b   c", "  ", "".join(map(chr, range(0xFDD0, 0xFDF0))) + "▁x"]
    found = pieces.Sampler(vocabulary).sample(texts, list(range(len(texts))))
    assert vocabulary.decode(pa.array(found, pa.binary())).to_pylist() == texts
