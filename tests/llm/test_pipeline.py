"""The pipeline, stage by stage, against plain computations over the same rows."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from millrace.llm import gam, toxicity
from millrace.llm.common import table

from .test_near import brute, classes


@pytest.fixture(scope="module")
def sf_dir():
    return "/root/testdata/sf0.01"  # the smallest tables have too few labels of a kind


@pytest.fixture(scope="module")
def stages(spark, sf_dir, tmp_path_factory):
    docs = table(spark, sf_dir, "documents")
    found = [("start", docs.toPandas())]
    for name, stage in corpus_pipeline.STAGES:
        place = str(tmp_path_factory.mktemp("stage") / name)
        stage(spark, docs, sf_dir).write.parquet(place)
        docs = spark.read.parquet(place)
        found.append((name, docs.toPandas()))
    return dict(found)


def test_stages_pass_rows_on_unchanged(stages):
    start = stages["start"].set_index("doc_id")
    for name in ("toxicity", "quality", "exact_dedup", "near_dedup"):
        kept = stages[name]
        assert list(kept.columns) == ["doc_id", *start.columns]
        assert kept.set_index("doc_id").equals(start.loc[kept.doc_id])
        assert not kept.empty


def test_classifiers_drop_what_they_reject_and_keep_clean_rows(spark, sf_dir, stages):
    labels = table(spark, sf_dir, "labels").toPandas().set_index("doc_id")
    docs = table(spark, sf_dir, "documents")
    model = toxicity.trained(docs, table(spark, sf_dir, "labels"))
    start, clean, good = (stages[n] for n in ("start", "toxicity", "quality"))
    assert set(clean.doc_id) == set(start.doc_id[model.score(start.text.fillna("")) < 0.5])
    lost = set(start.doc_id) - set(clean.doc_id)
    truth = labels[labels.index.isin(lost)]
    assert (truth.toxic == 1).mean() > 0.7
    bad = labels[labels.index.isin(set(clean.doc_id) - set(good.doc_id))]
    assert (bad.quality == 0).mean() > 0.8


def test_exact_stage_keeps_the_last_of_each_text(stages):
    before, after = stages["quality"], stages["exact_dedup"]
    want = before.assign(text=before.text.fillna("")).groupby("text").doc_id.max()
    assert sorted(after.doc_id) == sorted(want)


def test_near_stage_keeps_the_first_of_each_component(stages):
    before, after = stages["exact_dedup"], stages["near_dedup"]
    ids = before.doc_id.tolist()
    want = set(classes(ids, brute(before.text.tolist())))
    assert set(after.doc_id) == want


def test_packing_covers_every_document(stages):
    before, after = stages["near_dedup"], stages["packing"]
    assert set(after.doc_id) == set(before.doc_id)
    assert (after.groupby("doc_id").length.sum() == after.groupby("doc_id").doc_tokens.first()).all()


def test_whole_run_equals_its_stages(spark, sf_dir, stages):
    found = corpus_pipeline.run(spark, sf_dir).select("doc_id", "start", "length").collect()
    want = stages["packing"][["doc_id", "start", "length"]]
    assert sorted(map(tuple, found)) == sorted(want.itertuples(index=False, name=None))


def test_repeated_and_missing_rows_go_through(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").limit(20)
    extra = docs.select(
        F.lit(None).cast("bigint").alias("doc_id"), F.lit(None).cast("string").alias("text"),
        "lang", "source", "n_chars",
    ).limit(3)
    rows = docs.union(docs.limit(5)).union(extra)
    texts = rows.select(F.coalesce("text", F.lit(""))).distinct().count()
    assert corpus_pipeline.distinct_texts(spark, rows, sf_dir).count() == texts
    near = corpus_pipeline.distinct_prints(spark, rows, sf_dir)
    assert 0 < near.count() <= rows.count()
    assert corpus_pipeline.sequences(spark, rows, sf_dir).count() >= rows.count()


def test_empty_table(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, sf_dir).count() == 0
    assert gam.kept(docs, table(spark, sf_dir, "labels").limit(0)).count() == 0
