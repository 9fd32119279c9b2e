"""Quality classifier from weak labels.

Heuristic labellers each call a text good, bad or nothing. Expectation-
maximisation over the counts of all vote patterns in the corpus (at most
3 ** labellers rows) estimates how often each labeller errs on either class, and
with that a probability for every pattern. These posterior labels train a
logistic scorer on hashed features of a bounded sample, which then judges every
whole text. No given label takes part.

Defined results: a null, empty or blank text gets no votes, posterior and score
0, and is not kept. Texts too short for a labeller get no vote from it.
Repeated rows get equal scores; the sample is at most ``TRAIN_ROWS`` rows drawn
by hashes of id and text, so copies of a row may all teach. If all posterior
labels agree, every text with words gets that label's score. Columns other than
the text pass unchanged; input columns named like a result are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import eq
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import add_columns, as_bytes, received, ship
from tallyframe.llm.rules import STOP_WORDS

TRAIN_ROWS = 4000
DIMENSIONS = 1 << 12
EM_ROUNDS = 50
#: Below even odds, as the classes weigh the same in training: texts without evidence either way stay.
KEEP_FROM = 0.35
PIECE = 1 << 20
RESULT = "posterior double, score double, kept boolean"
GOOD, NONE, BAD = "+", "0", "-"

_STOPS = frozenset(w.encode() for words in STOP_WORDS.values() for w in words.split())
_SYMBOLS = b"#*$%&|<>"
_NOT_SYMBOLS = bytes(set(range(256)) - set(_SYMBOLS))
_NOT_UPPER = bytes(set(range(256)) - set(range(65, 91)))
_NOT_LOWER = bytes(set(range(256)) - set(range(97, 123)))
#: Shapes of bytes: capitals, other letters, digits and line ends each become one sign.
_SHAPE = bytes(
    65 if 65 <= b <= 90 else 97 if 97 <= b <= 122 or b > 127 else 48 if 48 <= b <= 57 else 32 if b in (9, 11, 12, 13) else b
    for b in range(256)
)
_BINS = np.array([0.0, 0.01, 0.03, 0.1, 0.2, 0.35, 0.5, 0.75])


class Labeller(NamedTuple):
    """Calls a text bad if the measure is at least ``bad``, good if at most ``good``; below ``words`` words nothing."""

    measure: str
    good: float
    bad: float
    words: int


LABELLERS = (
    Labeller("symbols", 0.05, 0.25, 3),
    Labeller("capitals", 0.15, 0.5, 5),
    Labeller("exclamations", 0.1, 0.4, 3),
    Labeller("same_as_before", 0.02, 0.15, 8),
    Labeller("repeated_windows", 0.1, 0.35, 20),
    Labeller("repeated_words", 0.6, 0.8, 20),
    Labeller("repeated_lines", 0.1, 0.4, 20),
    Labeller("cells", 0.02, 0.15, 5),
    Labeller("no_stop_words", 0.93, 0.985, 40),
)


def statistics(text: bytes) -> tuple[int, dict[str, float]]:
    """Number of words, and shares and rates over the whole text."""
    words = text.split()
    n = len(words)
    if not n:
        return 0, {}
    hashes = np.fromiter(map(hash, words), np.int64, n).view(np.uint64)
    same = sum(map(eq, words, words[1:]))
    different = len(np.unique(hashes))
    windows = hashes[: max(0, n - 4)].copy()
    for k in range(1, 5):
        windows = windows * np.uint64(0x9E3779B97F4A7C15) + hashes[k : k + len(windows)]
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    upper, lower = len(text.translate(None, _NOT_UPPER)), len(text.translate(None, _NOT_LOWER))
    stops = sum(map(_STOPS.__contains__, text.lower().split()))
    return n, {
        "symbols": len(text.translate(None, _NOT_SYMBOLS)) / n,
        "capitals": upper / max(1, upper + lower),
        "exclamations": text.count(b"!") / n,
        "same_as_before": same / n,
        "repeated_windows": 1 - len(np.unique(windows)) / len(windows) if len(windows) else 0.0,
        "repeated_words": 1 - different / n,
        "repeated_lines": 1 - len(set(lines)) / len(lines),
        "cells": text.count(b" | ") / n,
        "no_stop_words": 1 - stops / n,
    }


def votes(n: int, measured: dict[str, float], labellers: tuple[Labeller, ...] = LABELLERS) -> str:
    """A sign per labeller."""
    out = []
    for x in labellers:
        if n < max(1, x.words):
            out.append(NONE)
        else:
            value = measured[x.measure]
            out.append(BAD if value >= x.bad else GOOD if value <= x.good else NONE)
    return "".join(out)


def features(text: bytes, n: int, measured: dict[str, float]) -> np.ndarray:
    """Hashed three- and four-sign shapes of the whole text at length 1, and a mark for the bin of each measure."""
    out = np.zeros(DIMENSIONS, np.float32)
    for at in range(0, len(text), PIECE):
        shape = np.frombuffer(text[at : at + PIECE].translate(_SHAPE), np.uint8)
        fresh = np.concatenate([[True], (shape[1:] != shape[:-1]) | (shape[1:] != 97) & (shape[1:] != 48)])
        s = shape[fresh].astype(np.uint32)
        if len(s) < 4:
            continue
        three = (s[:-2] * np.uint32(257) + s[1:-1]) * np.uint32(257) + s[2:]
        for grams, salt in ((three, 0x9E3779B1), (three[:-1] * np.uint32(257) + s[3:], 0x85EBCA77)):
            out += np.bincount((grams * np.uint32(salt)) >> np.uint32(20), minlength=DIMENSIONS)
    out = np.sqrt(out)
    out /= max(float(np.linalg.norm(out)), 1e-9)
    for k, x in enumerate(LABELLERS):
        if n >= x.words:
            out[(k * 1021 + int(np.searchsorted(_BINS, measured[x.measure], side="right")) * 131 + 17) % DIMENSIONS] += 0.5
    return out


class LabelModel(NamedTuple):
    """Chance that a labeller that votes votes bad, given a good and a bad text; chance of a bad text."""

    bad_if_good: np.ndarray
    bad_if_bad: np.ndarray
    prior: float

    def posteriors(self, patterns: np.ndarray) -> np.ndarray:
        """Probability of good for rows of votes (1 good, -1 bad, 0 none)."""
        bad, good = patterns < 0, patterns > 0
        logs = [
            bad @ np.log(p) + good @ np.log(1 - p) + np.log(share)
            for p, share in ((self.bad_if_good, 1 - self.prior), (self.bad_if_bad, self.prior))
        ]
        return 1 / (1 + np.exp(np.clip(logs[1] - logs[0], -700, 700)))


def vote_matrix(patterns: list[str]) -> np.ndarray:
    return np.array([[(p == GOOD) - (p == BAD) for p in x] for x in patterns], np.int64).reshape(len(patterns), len(LABELLERS))


def expectation_maximisation(matrix: np.ndarray, counts: np.ndarray, rounds: int = EM_ROUNDS) -> LabelModel:
    """Accuracies and prior that fit the vote patterns, from the start that bad votes are rare but mostly right."""
    k = matrix.shape[1]
    model = LabelModel(np.full(k, 0.02), np.full(k, 0.3), 0.15)
    for _ in range(rounds):
        good = model.posteriors(matrix) * counts
        bad = counts - good
        rates = []
        for weight, guess in ((good, 0.02), (bad, 0.3)):
            voted = weight @ (matrix != 0)
            rates.append(np.clip((weight @ (matrix < 0) + 10 * guess) / (voted + 10), 1e-4, 1 - 1e-4))
        model = LabelModel(*rates, float(np.clip((bad.sum() + 1.5) / (counts.sum() + 10), 1e-3, 0.999)))
    return model


class Scorer(NamedTuple):
    weights: np.ndarray
    bias: float

    def score(self, x: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.weights @ x + self.bias, -60, 60))))


def train(x: np.ndarray, target: np.ndarray, rounds: int = 400, rate: float = 4.0, decay: float = 2e-5) -> Scorer:
    """Logistic regression on posterior labels; both classes weigh the same."""
    weights, bias = np.zeros(DIMENSIONS, np.float32), 0.0
    if not len(x):
        return Scorer(weights, bias)
    share = float(np.clip(target.mean(), 0.02, 0.98))
    importance = target * (0.5 / share) + (1 - target) * (0.5 / (1 - share))
    moving = np.zeros(DIMENSIONS, np.float32)
    for _ in range(rounds):
        guess = 1 / (1 + np.exp(-np.clip(x @ weights + bias, -60, 60)))
        error = ((guess - target) * importance / len(x)).astype(np.float32)
        moving = 0.9 * moving + error @ x + decay * weights
        weights = weights - rate * moving
        bias -= rate * float(error.sum())
    return Scorer(weights, bias)


class Model(NamedTuple):
    labels: LabelModel
    scorer: Scorer


def fit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", train_rows: int = TRAIN_ROWS) -> Model:
    """Estimate the labellers over all documents, then train the scorer on ``train_rows`` of them."""
    rows = docs.select(F.col(f"`{text}`").alias("text"), F.xxhash64(F.col(f"`{doc_id}`"), F.col(f"`{text}`")).alias("h"))
    rows = rows.filter("text IS NOT NULL")

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            signs = [votes(*statistics(t)) for t in as_bytes(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([pa.array(signs, pa.string())], ["votes"])

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            signs, blobs = [], []
            for t in as_bytes(batch.column("text")):
                n, measured = statistics(t)
                x = features(t, n, measured)
                at = np.flatnonzero(x)
                signs.append(votes(n, measured))
                blobs.append(at.astype(np.uint16).tobytes() + x[at].tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("h"), pa.array(signs, pa.string()), pa.array(blobs, pa.binary())], ["h", "votes", "x"])

    # At most 3 ** labellers patterns reach the driver.
    patterns = rows.select("text").mapInArrow(vote, "votes string").groupBy("votes").count().orderBy("votes").collect()
    model = expectation_maximisation(vote_matrix([p.votes for p in patterns]), np.array([p["count"] for p in patterns], float))
    # About twice the rows wanted pass a cut at a hash, so that no task ranks rows of the whole corpus.
    place = F.pmod(F.col("h"), F.lit(1 << 30)) / F.lit(1 << 30)
    drawn = rows.filter(place * sum(p["count"] for p in patterns) < 2 * train_rows + 50)
    described = drawn.mapInArrow(describe, "h bigint, votes string, x binary")
    taught = described.orderBy("h", "votes").limit(train_rows).collect()
    x = np.zeros((len(taught), DIMENSIONS), np.float32)
    for row, r in zip(x, taught, strict=True):
        n = len(r.x) // 6
        row[np.frombuffer(r.x[: 2 * n], np.uint16)] = np.frombuffer(r.x[2 * n :], np.float32)
    target = model.posteriors(vote_matrix([r.votes for r in taught]))
    return Model(model, train(x, target))


def judge(docs: DataFrame, model: Model, keep: list[str], text: str = "text", keep_from: float = KEEP_FROM) -> DataFrame:
    """The columns ``keep`` with the posterior label, the scorer's probability of good, and whether it reaches ``keep_from``."""
    shared = ship(docs.sparkSession.sparkContext, model)

    def start():
        labels, scorer = received(shared)

        def work(batch: pa.RecordBatch) -> list[pa.Array]:
            signs, scores = [], []
            for t in as_bytes(batch.column(text)):
                n, measured = statistics(t or b"")
                signs.append(votes(n, measured) if n else None)
                scores.append(scorer.score(features(t, n, measured)) if n else 0.0)
            known = sorted({s for s in signs if s})
            posterior = {None: 0.0} | dict(zip(known, labels.posteriors(vote_matrix(known)).tolist(), strict=True))
            kept = [s is not None and x >= keep_from for s, x in zip(signs, scores, strict=True)]
            return [pa.array([posterior[s] for s in signs], pa.float64()), pa.array(scores, pa.float64()), pa.array(kept, pa.bool_())]

        return work

    return add_columns(docs, text, keep, RESULT, start)
