"""Toxicity: a logistic classifier, regularised by counterfactual sentences.

Features are the words a text has and their beginnings. In labelled texts, sentences that name a
group are paired with the same sentence naming another, and the fit is
penalised for every change of the score between the two. So the weight that a
group's name takes from hostile sentences is not held against neutral mentions. Fitting takes at most
``SAMPLE`` labelled rows and keeps ``VOCABULARY`` features; scoring reads all texts in full.

Cases: a missing text is an empty one and is scored like any other. Missing ids and
repeated rows are scored as rows of their own. Labels that are missing, or belong to
no text, are ignored; without any label the score is 0.5. An empty table gives an
empty result.
"""

from __future__ import annotations

import re
import string
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fold, id_and_text, label_sample, stored

SAMPLE = 20_000
FOLDS, HELD_OUT = 5, 0
THRESHOLD = 0.5
VOCABULARY = 4096
BEGINNINGS = (4, 5, 6)
# Texts that must have a feature, and how clearly it must go with a label.
LEAST_TEXTS, LEAST_Z = 3, 2.2
RIDGE, COUNTERFACTUAL, ROUNDS = 5e-5, 1.0, 400
# Names that may stand for each other; a parameter of fitting.
IDENTITIES = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"), ("girl", "boy"), ("black", "white"),
    ("gay", "straight"), ("muslim", "christian", "jewish"), ("muslims", "christians", "jews"),
    ("immigrants", "locals"), ("disabled", "healthy"), ("young", "old"), ("trans", "cis"),
    ("femmes", "hommes"), ("femme", "homme"), ("noirs", "blancs"), ("juifs", "musulmans"),
    ("frauen", "männer"), ("frau", "mann"), ("juden", "muslime", "christen"),
    ("mujeres", "hombres"), ("mujer", "hombre"), ("negros", "blancos"), ("judíos", "musulmanes"),
)
_EDGES = string.punctuation + "“”„«»‘’…–—¡¿"
_SENTENCE = re.compile(r"[.!?\n]")


def words_of(text: str) -> set[str]:
    return {w.strip(_EDGES) for w in set(text.lower().split())}


def features_of(word: str) -> list[str]:
    """The word itself, and its beginnings by length."""
    return [word, *[f"{n} {word[:n]}" for n in BEGINNINGS if len(word) >= n]] if word else []


def swaps(text: str, groups: Iterable[tuple[str, ...]]) -> Iterator[tuple[str, str]]:
    """``named, other`` for every sentence with a name and every name it could have instead."""
    found = [w for w in words_of(text) if w]
    if not any(w in group for group in groups for w in found):
        return
    for sentence in _SENTENCE.split(text):
        words = words_of(sentence)
        for group in groups:
            for named in words.intersection(group):
                for other in group:
                    if other not in words:
                        yield named, other


# --- The model -----------------------------------------------------------------


@dataclass
class Model:
    intercept: float = 0.0
    weights: dict[str, float] = field(default_factory=dict)

    def score(self, texts: Iterable[str]) -> np.ndarray:
        """Scores of whole texts; only words that carry a weight are looked at closer."""
        weights = self.weights
        heads = {w.split(" ", 1)[1][:4] if " " in w else w[:4] for w in weights}
        total = []
        for text in texts:
            found = set()
            for word in words_of(text):
                if word[:4] in heads:
                    found.update(f for f in features_of(word) if f in weights)
            # Sorted, so that the sum does not depend on the order of a set.
            total.append(self.intercept + sum(weights[f] for f in sorted(found)))
        return 1 / (1 + np.exp(-np.clip(np.array(total, np.float64), -500, 500)))


def fit(
    texts: list[list[int]], y: np.ndarray, names: list[str],
    changes: list[tuple[list[int], list[int], int]], strength: float = COUNTERFACTUAL,
) -> Model:
    """Weights for texts given as feature numbers, by full gradients.

    ``changes`` has the features that a swap adds and takes away and how
    often it occurs; ``strength`` weighs the squared change of the score.
    """
    if not len(y) or y.min() == y.max():
        share = (y.sum() + 1) / (len(y) + 2)
        return Model(float(np.log(share / (1 - share))))
    k, n = len(names), len(y)
    rows = np.repeat(np.arange(n), [len(t) for t in texts])
    columns = np.array([f for t in texts for f in t], np.int64)
    delta = np.zeros((len(changes), k))
    for i, (added, taken, _) in enumerate(changes):
        delta[i, added] += 1
        delta[i, taken] -= 1
    often = np.array([c for _, _, c in changes], np.float64)
    often /= max(1.0, often.sum())
    w, b = np.zeros(k), float(np.log(y.mean() / (1 - y.mean())))
    moments = np.zeros((2, k + 1))
    for step in range(1, ROUNDS + 1):
        p = 1 / (1 + np.exp(-(b + np.bincount(rows, w[columns], n))))
        error = p - y
        slope = np.bincount(columns, error[rows], k) / n + RIDGE * w
        if len(changes):
            slope += 2 * strength * delta.T @ (often * (delta @ w))
        g = np.append(slope, error.mean())
        moments[0] = 0.9 * moments[0] + 0.1 * g
        moments[1] = 0.99 * moments[1] + 0.01 * g * g
        rate = 0.1 * min(1.0, 4 * (1 - step / (ROUNDS + 1)))
        move = rate * (moments[0] / (1 - 0.9**step)) / (np.sqrt(moments[1] / (1 - 0.99**step)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    return Model(float(b), {name: float(v) for name, v in zip(names, w, strict=True) if v})


# --- Over tables ---------------------------------------------------------------


def _telling(known: DataFrame, good: int, bad: int, most: int) -> list[str]:
    """Features that go most clearly with a label, by the log odds of having them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                sorted({f for w in words_of(t.as_py()) for f in features_of(w)})
                for t in batch.column("text")
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array(found, pa.list_(pa.string())), batch.column("label")], ["features", "label"]
            )

    each = known.select("text", "label").mapInArrow(run, "features array<string>, label int")
    seen = each.select(F.explode("features").alias("feature"), "label").groupBy("feature").agg(
        F.sum("label").alias("bad"), F.count("*").alias("n")
    )
    a, c = F.col("bad") + 0.5, F.col("n") - F.col("bad") + 0.5
    odds = F.log(a / (bad + 1 - a)) - F.log(c / (good + 1 - c))
    z = F.abs(odds) / F.sqrt(1 / a + 1 / c)
    chosen = seen.filter((F.col("n") >= LEAST_TEXTS) & (z >= LEAST_Z))
    return [r.feature for r in chosen.orderBy(F.desc(z), "feature").limit(most).select("feature").collect()]


def trained(
    docs: DataFrame, labels: DataFrame, identities: tuple[tuple[str, ...], ...] = IDENTITIES,
    strength: float = COUNTERFACTUAL, sample: int = SAMPLE,
) -> Model:
    """The model of a bounded sample of labelled texts outside the held-out fold."""
    chosen = label_sample(labels, "toxic", FOLDS, HELD_OUT, sample)
    # The bound is on ids; of rows that repeat one, a single row counts.
    one = F.min_by("text", F.xxhash64("text")).alias("text")
    found = id_and_text(docs).join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label").agg(one)
    known = stored(found.select("doc_id", "text", "label"), "labelled")
    counted = {r.label: r.n for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    names = _telling(known, counted.get(0, 0), counted.get(1, 0), VOCABULARY)
    terms = [f for group in identities for w in group for f in features_of(w)]
    names = sorted({*names, *terms})
    number = {f: i for i, f in enumerate(names)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.as_py() for t in batch.column("text")]
            found = [sorted({number[f] for w in words_of(t) for f in features_of(w) if f in number}) for t in texts]
            pairs = [sorted(f"{a} {b}" for a, b in swaps(t, identities)) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("label"),
                 pa.array(found, pa.list_(pa.int32())), pa.array(pairs, pa.list_(pa.string()))],
                ["doc_id", "label", "found", "pairs"],
            )

    kind = known.schema["doc_id"].dataType.simpleString()
    numbered = known.mapInArrow(
        run, f"doc_id {kind}, label int, found array<int>, pairs array<string>"
    )
    numbered = stored(numbered, "numbered")
    rows = sorted(numbered.select("doc_id", "label", "found").collect())
    # At most the square of a group's names.
    swapped = numbered.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n"))
    changes = []
    for pair, n in sorted(map(tuple, swapped.collect())):
        old, new = [{number[f] for f in features_of(w)} for w in pair.split(" ")]
        changes.append((sorted(new - old), sorted(old - new), n))
    return fit([r.found for r in rows], np.array([r.label for r in rows], np.int64), names, changes, strength)


def text_score(model: Model) -> Column:
    """Score of the column ``text``, for filters on tables of any columns."""

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(model.score(texts))

    return score(F.coalesce("text", F.lit("")))


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row."""
    model = trained(docs, labels)
    rows = id_and_text(docs).select(
        "doc_id", F.coalesce(fold(FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
        text_score(model).alias("score"),
    )
    return rows.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def kept(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows whose text the classifier takes for clean, all columns as they are."""
    return docs.filter(text_score(trained(docs, labels)) < THRESHOLD)
