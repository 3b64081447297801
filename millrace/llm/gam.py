"""Quality classifier: a generalised additive model with pairwise interactions.

Shallow trees are boosted in cycles, one feature at a time, on histograms of its
bins; each feature's trees add up to one lookup table. Then the pairs of features
that explain most of what is left get tables of their own in the same way. A score
is the sum of one entry per table, added up for whole batches. Fitting takes at most
``SAMPLE`` labelled rows, scoring all texts in full.

Cases: a missing text is an empty one and is scored like any other. Missing ids and
repeated rows are scored as rows of their own. Labels that are missing, or belong to no
text, are ignored; without any label of one kind every score is the share of the other, and
0.5 without labels. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fold, id_and_text, label_sample, stored
from .textstats import COUNTS, counts

SAMPLE = 20_000
FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.7
BINS, PAIR_BINS, PAIRS = 32, 8, 6
CYCLES, RATE, RIDGE = 120, 0.15, 1.0
FEATURES = (
    "words", "length", "symbols", "repeats", "lines", "variety", "same", "capitals", "digits",
    "bangs", "odd", "stops", "bars", "commonest", "longest",
)


def features(found: np.ndarray) -> np.ndarray:
    """One row of features per row of counts."""
    c = {name: found[:, i].astype(np.float64) for i, name in enumerate(COUNTS)}
    words = np.maximum(1, c["n_words"])
    chars = np.maximum(1, c["word_chars"])
    return np.stack(
        [
            np.log1p(c["n_words"]), chars / words, c["n_symbols"] / chars,
            c["n_repeat_words"] / words, c["n_dup_lines"] / np.maximum(1, c["n_lines"]),
            np.log1p(c["n_distinct"]) / np.log1p(words), c["n_same_pair"] / words,
            c["n_upper"] / np.maximum(1, c["n_upper"] + c["n_lower"]), c["n_digits"] / chars,
            c["n_bangs"] / words, c["n_odd_words"] / words, c["n_stops"] / words,
            c["n_bars"] / words, c["n_common"] / words, np.log1p(c["longest_word"]),
        ],
        axis=1,
    )


# --- The model -----------------------------------------------------------------


@dataclass
class Model:
    intercept: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    pairs: dict[tuple[int, int], np.ndarray] = field(default_factory=dict)

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.intercept)
        for f, (edges, table) in enumerate(zip(self.edges, self.tables, strict=True)):
            total += table[np.searchsorted(edges, x[:, f], "right")]
        for (i, j), table in self.pairs.items():
            total += table[
                np.searchsorted(self.coarse[i], x[:, i], "right"),
                np.searchsorted(self.coarse[j], x[:, j], "right"),
            ]
        return 1 / (1 + np.exp(-np.clip(total, -500, 500)))


def _edges(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.arange(1, bins) / bins, method="inverted_cdf"))


def _leaf(g, h):
    return g / (h + RIDGE)


def _cut(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """Gain of the best cut of a run of bins, and the bins before it."""
    left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gain = left_g * _leaf(left_g, left_h) + (g.sum() - left_g) * _leaf(g.sum() - left_g, h.sum() - left_h)
    best = int(np.argmax(gain))
    return float(gain[best] - g.sum() * _leaf(g.sum(), h.sum())), best + 1


def _tree(g: np.ndarray, h: np.ndarray, leaves: int = 3) -> np.ndarray:
    """Values per bin of a tree with a few leaves, grown at the best cut each time."""
    runs = [(0, len(g))]
    while len(runs) < leaves:
        options = [(*_cut(g[a:b], h[a:b]), a, b) for a, b in runs if b - a > 1]
        if not options or max(options)[0] <= 1e-12:
            break
        _, at, a, b = max(options)
        runs[runs.index((a, b))] = (a, a + at)
        runs.append((a + at, b))
    values = np.zeros(len(g))
    for a, b in runs:
        values[a:b] = _leaf(g[a:b].sum(), h[a:b].sum())
    return values


def _quarters(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and values of the best tree that cuts each of two features once."""
    rows, columns = g.shape
    if min(rows, columns) < 2:
        return 0.0, np.zeros(g.shape)
    cg, ch = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)

    def parts(c):
        upper_left = c[:-1, :-1]
        return (
            upper_left, c[:-1, -1:] - upper_left, c[-1:, :-1] - upper_left,
            c[-1, -1] - c[:-1, -1:] - c[-1:, :-1] + upper_left,
        )

    gain = sum(pg * _leaf(pg, ph) for pg, ph in zip(parts(cg), parts(ch), strict=True))
    a, b = np.unravel_index(int(np.argmax(gain)), gain.shape)
    values = np.zeros(g.shape)
    for across in (slice(0, a + 1), slice(a + 1, None)):
        for along in (slice(0, b + 1), slice(b + 1, None)):
            values[across, along] = _leaf(g[across, along].sum(), h[across, along].sum())
    return float(gain[a, b]), values


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """The model of labelled rows; their number is the caller's to bound."""
    if not len(y) or y.min() == y.max():
        share = (y.sum() + 1) / (len(y) + 2) if len(y) else 0.5
        return Model(float(np.log(share / (1 - share))))
    y = y.astype(np.float64)
    model = Model(float(np.log(y.mean() / (1 - y.mean()))))
    model.edges = [_edges(x[:, f], BINS) for f in range(x.shape[1])]
    model.coarse = [_edges(x[:, f], PAIR_BINS) for f in range(x.shape[1])]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    bins = [np.searchsorted(e, x[:, f], "right") for f, e in enumerate(model.edges)]
    total = np.full(len(y), model.intercept)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return y - p, p * (1 - p)

    for _ in range(CYCLES):
        for f, table in enumerate(model.tables):
            g, h = slopes()
            step = RATE * _tree(np.bincount(bins[f], g, len(table)), np.bincount(bins[f], h, len(table)))
            table += step
            total += step[bins[f]]
    coarse = [np.searchsorted(e, x[:, f], "right") for f, e in enumerate(model.coarse)]
    sizes = [len(e) + 1 for e in model.coarse]

    def crossed(i, j, weights):
        found = np.bincount(coarse[i] * sizes[j] + coarse[j], weights, sizes[i] * sizes[j])
        return found.reshape(sizes[i], sizes[j])

    g, h = slopes()
    ranked = sorted(
        combinations(range(x.shape[1]), 2),
        key=lambda p: -_quarters(crossed(*p, g), crossed(*p, h))[0],
    )
    model.pairs = {p: np.zeros((sizes[p[0]], sizes[p[1]])) for p in ranked[:PAIRS]}
    for _ in range(CYCLES // 2):
        for (i, j), table in model.pairs.items():
            g, h = slopes()
            step = RATE * _quarters(crossed(i, j, g), crossed(i, j, h))[1]
            table += step
            total += step[coarse[i], coarse[j]]
    return model


# --- Over tables ---------------------------------------------------------------


def _features_of(texts) -> np.ndarray:
    found = np.array([counts(t) for t in texts], np.int64).reshape(-1, len(COUNTS))
    return features(found)


def featured(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the features of its text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _features_of(t.as_py() for t in batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(c) for c in x.T]], ["doc_id", *FEATURES]
            )

    rows = id_and_text(docs)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, ", ".join([f"doc_id {kind}", *[f"{c} double" for c in FEATURES]]))


def trained(known: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE) -> Model:
    """The model of a bounded sample of labels outside the held-out fold."""
    chosen = label_sample(labels, label, FOLDS, HELD_OUT, sample)
    # The bound is on ids; of rows that repeat one, a single row counts.
    one = F.min_by(F.struct(*FEATURES), F.xxhash64(*FEATURES)).alias("x")
    found = known.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label").agg(one)
    rows = found.select("doc_id", "label", "x.*").collect()
    rows.sort()
    data = np.array([r[2:] for r in rows], np.float64).reshape(-1, len(FEATURES))
    return fit(data, np.array([r.label for r in rows], np.int64))


def text_score(model: Model) -> Column:
    """Score of the column ``text``, for filters on tables of any columns."""

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(model.score(_features_of(texts)))

    return score(F.coalesce("text", F.lit("")))


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row."""
    known = stored(featured(docs), "features")
    model = trained(known, labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.stack([batch.column(c).to_numpy() for c in FEATURES], axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(model.score(x))], ["doc_id", "score"]
            )

    kind = known.schema["doc_id"].dataType.simpleString()
    return known.mapInArrow(run, f"doc_id {kind}, score double").select(
        "doc_id", F.coalesce(fold(FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def kept(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows whose text the classifier takes for good, all columns as they are."""
    chosen = label_sample(labels, "quality", FOLDS, HELD_OUT, SAMPLE)
    # Only the sampled rows' texts are measured for fitting.
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen.select("doc_id")), "doc_id", "left_semi")
    model = trained(stored(featured(rows), "features"), labels)
    return docs.filter(text_score(model) >= THRESHOLD)
