"""Quality rules under weak supervision.

Every rule votes to keep a text, votes against it, or abstains. No rule decides
alone and no label is read: expectation-maximisation estimates, from how the votes of all
texts fall together, how often each rule says what of good and of bad texts, and
the posterior probability of a good text replaces the filter that all rules must
pass. A base filter comes first. The votes of a text are one of
3 ** rules patterns, so the estimation works on their counts.

Cases: a missing or text without words has no words and fails the base filter, as does any
text under 50 words. Missing ids and repeated rows are rows like any other. An
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import id_and_text, stored
from .textstats import COUNTS, counts

AGAINST, KEEP, ABSTAIN = 0, 1, 2
LEAST_WORDS = 50


def measured(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the counts of its text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([counts(t.as_py()) for t in batch.column("text")], np.int64)
            columns = found.reshape(-1, len(COUNTS)).T
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *map(pa.array, columns)], ["doc_id", *COUNTS]
            )

    rows = id_and_text(docs)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, ", ".join([f"doc_id {kind}", *[f"{c} bigint" for c in COUNTS]]))


def _share(a: str, b: str) -> Column:
    return F.try_divide(F.col(a).cast("double"), F.col(b).cast("double"))


def rules() -> dict[str, tuple[Column, Column]]:
    """By name: when a rule votes against a text and when for it."""
    symbols = _share("n_symbols", "word_chars")
    repeats = _share("n_repeat_words", "n_words")
    lines = _share("n_dup_lines", "n_lines")
    variety = F.try_divide(F.log("n_distinct"), F.log("n_words"))
    same = _share("n_same_pair", "n_words")
    capitals = F.try_divide(F.col("n_upper"), F.col("n_upper") + F.col("n_lower"))
    odd = _share("n_odd_words", "n_words")
    stops = _share("n_stops", "n_words")
    bars = _share("n_bars", "n_words")
    length = _share("word_chars", "n_words")
    return {
        "symbols": (symbols > 0.05, symbols < 0.01),
        "repeats": (repeats > 0.3, repeats < 0.1),
        "lines": (lines > 0.3, (lines < 0.05) & (F.col("n_lines") > 1)),
        "variety": (variety < 0.72, variety > 0.82),
        "same": (same > 0.1, same < 0.03),
        "capitals": (capitals > 0.5, capitals < 0.15),
        "odd": (odd > 0.3, odd < 0.05),
        "stops": ((stops == 0) | (stops > 0.5), stops.between(0.01, 0.25)),
        "bars": (bars > 0.1, bars == 0),
        "length": ((length < 2.5) | (length > 12), length.between(3, 9)),
    }


def pattern(chosen: dict[str, tuple[Column, Column]]) -> Column:
    """The votes of all rules as one number in base 3."""
    total = F.lit(0)
    for against, keep in chosen.values():
        vote = F.when(against, AGAINST).when(keep, KEEP).otherwise(ABSTAIN)
        total = total * 3 + vote
    return total


def votes_of(patterns: np.ndarray, n_rules: int) -> np.ndarray:
    return patterns[:, None] // 3 ** np.arange(n_rules - 1, -1, -1) % 3


def posterior(patterns: np.ndarray, weights: np.ndarray, n_rules: int, rounds: int = 200) -> np.ndarray:
    """Probability that texts of each pattern are good."""
    if not len(patterns):
        return np.zeros(0)
    votes = votes_of(patterns, n_rules)
    spoken = np.maximum(1, (votes != ABSTAIN).sum(axis=1))
    good = 0.1 + 0.8 * (votes == KEEP).sum(axis=1) / spoken
    good[(votes == ABSTAIN).all(axis=1)] = 0.5
    each = np.stack([votes == v for v in (AGAINST, KEEP, ABSTAIN)]).astype(float)
    for _ in range(rounds):
        likely = np.zeros((2, len(patterns)))
        shares = []
        for c, p in enumerate((1 - good, good)):
            mass = (weights * p).sum()
            table = ((each * (weights * p)[:, None]).sum(axis=1) + 1) / (mass + 3)
            shares.append(table)
            likely[c] = np.log((mass + 1) / (weights.sum() + 2))
        # A rule may be useless, but not wrong more often than right.
        upside_down = np.log(shares[1][KEEP] / shares[1][AGAINST]) < np.log(shares[0][KEEP] / shares[0][AGAINST])
        for c in (0, 1):
            told = np.log(shares[c])
            told[:, upside_down] = 0
            likely[c] += told[votes, np.arange(n_rules)].sum(axis=1)
        new = 1 / (1 + np.exp(np.clip(likely[0] - likely[1], -500, 500)))
        if np.abs(new - good).max() < 1e-9:
            break
        good = new
    return good


def judged(docs: DataFrame) -> DataFrame:
    """Base counts, ``base_failed``, ``quality`` (the posterior) and ``kept`` for every row."""
    chosen = rules()
    base = F.coalesce(
        (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")), F.lit(True)
    )
    rows = stored(
        measured(docs).select(
            "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
            base.alias("base_failed"), pattern(chosen).alias("votes"),
        ),
        "votes",
    )
    # At most 3 ** rules patterns, 59,049 with ten rules. Base failures have no say in them.
    found = rows.filter(~F.col("base_failed")).groupBy("votes").agg(F.count("*").alias("n")).collect()
    numbers = np.array([r.votes for r in found], np.int64)
    good = posterior(numbers, np.array([r.n for r in found], float), len(chosen))
    table = rows.sparkSession.createDataFrame(
        list(zip(numbers.tolist(), good.tolist(), strict=True)), "votes int, quality double"
    )
    kept = ~F.col("base_failed") & (F.coalesce("quality", F.lit(0.0)) >= 0.5)
    return rows.join(F.broadcast(table), "votes", "left").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", kept.alias("kept"), "quality",
    )
