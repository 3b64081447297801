import random

import pytest
from pyspark.sql import functions as F

from millrace.llm import exact

SCHEMA = "doc_id bigint, text string, recipe string, part string, chunk string"


def _rows():
    draw = random.Random(2)
    long = "".join(draw.choices("abc def. ghi\n", k=60_000))
    texts = ["a", "a", "", None, "A", "a ", long, long, long[:-1] + "!", "x" * 20_000, "x" * 20_000,
             "😀a" * 9_000, "😀a" * 9_000, "é", "é"]
    rows = [(i, t, "r", "p", "c") for i, t in enumerate(texts, 10)]
    return [*rows, rows[1], (None, "a", "", "", ""), (None, "only", "", "", ""), (None, "only", "", "", "")]


def _want(rows):
    same = {}
    for i, t, *_ in rows:
        same.setdefault(t or "", []).append(i)
    want = []
    for i, t, *_ in rows:
        known = [x for x in same[t or ""] if x is not None]
        want.append((str(i), str(max(known, default=None)), len(same[t or ""])))
    return sorted(want), len(same)


@pytest.mark.parametrize("bits", [64, 3])
def test_groups_equal_brute_force(spark, bits, monkeypatch):
    rows = _rows()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    if bits < 64:
        plain = exact.recipes
        monkeypatch.setattr(exact, "recipes", lambda d: plain(d, bits=bits))
    got = exact.deduplicated(docs).collect()
    want, texts = _want(rows)
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size) for r in got) == want
    kept = [r for r in got if r.kept]
    assert len(kept) == texts
    assert all(r.doc_id == r.keep_id for r in kept)


def test_chunks_join_to_the_text_and_stay_in_bounds(spark):
    docs = spark.createDataFrame(_rows(), SCHEMA).filter("text is not null")
    found = docs.select("text", exact.chunks(F.col("text")).alias("c")).collect()
    for text, c in found:
        assert "".join(c) == text
        assert all(exact.LEAST <= len(x) <= exact.MOST for x in c[:-1])


def test_an_edit_leaves_far_chunks_alone(spark):
    text = "".join(random.Random(4).choices("abcdefgh .\n", k=40_000))
    docs = spark.createDataFrame([(1, text), (2, "new words. " + text)], "doc_id int, text string")
    a, b = [set(r.c) for r in docs.select(exact.chunks(F.col("text")).alias("c")).collect()]
    assert len(a & b) > 0.9 * len(a)


def test_no_python_in_the_plan(spark):
    docs = spark.range(5).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    plan = exact.deduplicated(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_empty_table(spark):
    assert exact.deduplicated(spark.createDataFrame([], SCHEMA)).count() == 0
