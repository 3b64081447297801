import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import gam, rules, sharding, textstats, toxicity
from millrace.llm.common import table

SCHEMA = "doc_id bigint, text string, score double, label string, votes string"
DIR = "/root/testdata/sf0.01"


def _auc(scores, truth):
    order = np.argsort(np.argsort(scores)) + 1
    good = truth == 1
    return (order[good].sum() - good.sum() * (good.sum() + 1) / 2) / good.sum() / (~good).sum()


def _odd_rows(spark):
    rows = [(-1, None), (-2, ""), (-3, " \n"), (None, "a b"), (-5, "é" * 50)]
    rows += [(-4, "x " * 90_000)] * 2
    return spark.createDataFrame([(i, t, 0.0, "", "") for i, t in rows], SCHEMA)


@pytest.mark.parametrize("module, label", [(toxicity, "toxic"), (gam, "quality")])
def test_held_out_rows_are_told_apart(spark, module, label):
    docs, labels = table(spark, DIR, "documents"), table(spark, DIR, "labels")
    found = module.scored(docs, labels).join(labels, "doc_id").toPandas()
    held = found[found.held_out & found[label].notna()]
    assert _auc(held.score.to_numpy(), held[label].to_numpy()) > 0.9
    assert ((held.predicted == held[label]).mean()) > 0.88
    assert (found.predicted == (found.score >= module.THRESHOLD)).all()


@pytest.mark.parametrize("module", [toxicity, gam])
def test_odd_rows_get_scores(spark, module):
    labels = table(spark, DIR, "labels")
    docs = _odd_rows(spark).select("doc_id", "text", "score", "label", "votes")
    extra = table(spark, DIR, "documents").select("doc_id", "text", F.lit(0.0), F.lit(""), F.lit(""))
    found = module.scored(docs.union(extra), labels).collect()
    assert len(found) == 1007 and all(0 <= r.score <= 1 for r in found)
    none = module.scored(docs, labels.limit(0)).collect()
    assert len(none) == 7 and {round(r.score, 6) for r in none} == {0.5}
    odd = labels.withColumns({"toxic": F.lit(None).cast("int"), "quality": F.lit(None).cast("int")})
    assert module.scored(docs, odd.union(labels.limit(3))).count() == 7
    assert module.scored(docs.limit(0), labels).count() == 0


def test_scores_do_not_depend_on_held_out_labels(spark):
    docs, labels = table(spark, DIR, "documents"), table(spark, DIR, "labels")
    flipped = labels.withColumn(
        "quality", F.when(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, 1 - F.col("quality")).otherwise(F.col("quality"))
    )
    a, b = [{r.doc_id: r.score for r in gam.scored(docs, x).collect()} for x in (labels, flipped)]
    assert a == b


def test_counterfactuals_clear_the_names_of_groups(spark):
    hostile = ["idiot", "scum", "trash", "moron"]
    calm = ["table", "garden", "river", "music"]
    rows, labels = [], []
    for i in range(400):
        bad = i % 2
        # Hostile texts mention one group far more often than calm ones do.
        name = ("women" if i % 10 < 8 else "men") if bad else ("men" if i % 10 < 9 else "women")
        words = (hostile if bad else calm)[i % 4]
        rows.append((i, f"the {name} near the {words if i % 3 else 'house'} today"))
        labels.append((i, 1, bad))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    known = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    plain = toxicity.trained(docs, known, strength=0.0)
    fair = toxicity.trained(docs, known, strength=10.0)
    neutral = ["the women near the house today", "the men near the house today"]
    assert abs(np.diff(plain.score(neutral))[0]) > 0.3
    assert abs(np.diff(fair.score(neutral))[0]) < 0.05
    assert (fair.score(["the women idiot", "the men scum"]) > 0.5).all()


def test_swaps_name_every_other_member():
    groups = (("a", "b", "c"), ("x", "y"))
    assert sorted(toxicity.swaps("one a. two", groups)) == [("a", "b"), ("a", "c")]
    assert list(toxicity.swaps("a b c", groups)) == []


def test_pairs_learn_what_single_features_cannot():
    draw = np.random.default_rng(1)
    x = draw.random((4_000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(int)
    model = gam.fit(x, y)
    assert (0, 1) in model.pairs
    z = draw.random((2_000, 3))
    truth = (z[:, 0] > 0.5) ^ (z[:, 1] > 0.5)
    assert ((model.score(z) > 0.5) == truth).mean() > 0.9


# --- Rules -----------------------------------------------------------------------


def test_base_counts_equal_brute_force(spark):
    texts = [r.text for r in table(spark, "/root/testdata/sf0.001", "documents").collect()]
    texts += ["a b c a b c x", "a\na\n\n \na ", "A#*$%&|<> é 😀", "x\x0by\x0cz\tq", "w " * 5]
    for text in texts:
        found = dict(zip(textstats.COUNTS, textstats.counts(text), strict=True))
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
        windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
        covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)} if len(words) < 3_000 else None
        lines = [s for s in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", s)]
        assert found["n_words"] == len(words)
        assert found["word_chars"] == sum(map(len, words))
        assert found["n_symbols"] == sum(c in "#*$%&|<>" for c in text)
        assert found["n_dup_lines"] == len(lines) - len(set(lines))
        if covered is not None:
            assert found["n_repeat_words"] == len(covered)


def test_estimation_finds_planted_accuracies():
    draw = np.random.default_rng(2)
    n, accuracy = 60_000, np.array([0.95, 0.9, 0.8, 0.7, 0.6])
    good = draw.random(n) < 0.7
    right = draw.random((n, 5)) < accuracy
    votes = np.where(right == good[:, None], rules.KEEP, rules.AGAINST)
    votes[draw.random((n, 5)) < 0.2] = rules.ABSTAIN
    numbers, weights = np.unique(votes @ 3 ** np.arange(4, -1, -1), return_counts=True)
    found = dict(zip(numbers.tolist(), rules.posterior(numbers, weights.astype(float), 5), strict=True))
    told = np.array([found[v] for v in (votes @ 3 ** np.arange(4, -1, -1)).tolist()]) > 0.5
    majority = (votes == rules.KEEP).sum(axis=1) > (votes == rules.AGAINST).sum(axis=1)
    assert (told == good).mean() > (majority == good).mean() > 0.8


def test_verdicts_agree_with_labels_never_read(spark):
    docs, labels = table(spark, DIR, "documents"), table(spark, DIR, "labels")
    found = rules.judged(docs).withColumnRenamed("quality", "posterior").join(labels, "doc_id").toPandas()
    rest = found[~found.base_failed]
    assert (rest.kept == (rest.quality == 1)).mean() > 0.97
    assert not found[found.base_failed].kept.any()


def test_rules_on_odd_rows(spark):
    found = rules.judged(_odd_rows(spark)).collect()
    assert len(found) == 7 and all(r.base_failed and not r.kept for r in found)
    assert rules.judged(_odd_rows(spark).limit(0)).count() == 0


# --- Shards ----------------------------------------------------------------------


def test_tree_gives_the_tightest_bin():
    draw = np.random.default_rng(3)
    tree, rooms = sharding.Tree(), []
    for name in range(3_000):
        if rooms and draw.random() < 0.5:
            size = int(draw.integers(1, 200))
            want = min((r for r in rooms if r[0] >= size), default=None)
            assert tree.take(size) == want
            if want:
                rooms.remove(want)
        else:
            rooms.append((int(draw.integers(1, 150)), name))
            tree.add(*rooms[-1])


def test_best_fit_decreasing_and_equal_shards():
    assert list(sharding.best_fit([7, 6, 4, 3], 10)) == [0, 1, 1, 0]
    assert list(sharding.best_fit([20, 5], 10)) == [0, 1]
    draw = np.random.default_rng(4)
    sizes = sorted(draw.integers(1, 1_000, 900).tolist(), reverse=True)
    into = sharding.fixed_number(sizes, 16)
    loads = np.bincount(into, sizes, 16)
    assert loads.max() / loads.min() < 1.01
    hot = sharding.fixed_number([5_000, *[10] * 300], 16)
    loads = np.bincount(hot, [5_000, *[10] * 300], 16)
    assert loads[0] == 5_000 and loads[1:].max() <= 220 and loads[1:].min() >= 150
    assert sharding.fixed_number([], 16) == [] and max(sharding.fixed_number([1, 1], 16)) < 16


def test_shards_hold_whole_groups(spark):
    docs = table(spark, DIR, "documents").select("doc_id", "text", F.lit("s").alias("shard"), F.lit(1).alias("size"))
    odd = _odd_rows(spark).select("doc_id", "text", "label", F.lit(1))
    found = sharding.sharded(docs.union(odd)).toPandas()
    assert len(found) == 1_007 and set(found.law) == {"bytes"}
    texts = {r.doc_id: r.text or "" for r in docs.union(odd).collect()}
    at = {}
    for r in found.itertuples():
        if r.doc_id == r.doc_id:
            assert r.size == len(texts[r.doc_id].encode()) + 1
            at.setdefault(texts[r.doc_id], set()).add(r.shard)
    assert all(len(s) == 1 for s in at.values())
    for _, own in found.groupby("shard"):
        assert sorted(own.slot) == list(range(len(own)))
    assert sharding.sharded(docs.limit(0)).count() == 0


def test_many_buckets_are_packed_in_levels(spark, monkeypatch):
    monkeypatch.setattr(sharding, "GROUPS_PER_BUCKET", 4)
    monkeypatch.setattr(sharding, "BLOCKS", 4)
    rows = [(i, f"{i // 2} " + "x" * (i * 7919 % 500)) for i in range(1_900)] + [(None, None), (7, "hot")] * 40
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    packed = []
    pack = sharding.group_blocks
    monkeypatch.setattr(sharding, "group_blocks", lambda g, c, b: packed.append(b) or pack(g, c, b))
    found = sharding.sharded(docs).toPandas()
    assert len(packed) == 2 and packed[0] > sharding.BUCKETS
    assert len(found) == len(rows) and found["size"].sum() == sum(len(t or "") + 1 for _, t in rows)
    assert (found.groupby("text_crc32")["shard"].nunique() == 1).all()
    for _, own in found.groupby("shard"):
        assert sorted(own["slot"]) == list(range(len(own)))
    loads = found.groupby("shard")["size"].sum()
    assert len(loads) == 16 and loads.max() - loads.min() < 0.2 * loads.mean()


@pytest.mark.parametrize("module, label", [(toxicity, "toxic"), (gam, "quality")])
def test_rows_that_repeat_an_id_are_fitted_once(spark, module, label, monkeypatch):
    texts = [(i, f"some words {i % 7}") for i in range(40)] + [(3, f"other words {k}") for k in range(500)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string").repartition(4)
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], f"doc_id bigint, {label} int")
    sizes, fit = [], module.fit
    monkeypatch.setattr(module, "fit", lambda x, y, *more: sizes.append((len(x), len(y))) or fit(x, y, *more))
    assert module.scored(docs, labels).count() == 540
    chosen = module.label_sample(labels, label, module.FOLDS, module.HELD_OUT, module.SAMPLE).count()
    assert sizes == [(chosen, chosen)]
