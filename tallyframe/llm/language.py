"""Language identification in two levels.

A text becomes counts of hashed letter pairs and triples of its whole length.
The first level chooses the language family, the second the language within it:
linear support vector machines, one for each pair of classes, vote at both
levels. Pairs are trained only inside a family, so each separates what is close.

The machines are fitted on at most ``PER_LANGUAGE`` rows of a language, drawn by
hashes of their ids; the number of weights depends on languages only.

Defined results: a null text, a text without a letter, and every text if nothing
was learned are ``und`` with score 0. Rows without id or language teach nothing;
of rows with equal id one teaches. Ties go to the language that sorts first.
Repeated rows get equal answers. Columns other than the text pass unchanged, but
input columns named like a result are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.llm.common import add_columns, received, ship

PER_LANGUAGE = 300
DIMENSIONS = 1 << 14
PIECE = 1 << 20
UNKNOWN = "und"
RESULT = "lang_pred string, score double"
#: Letters, and number signs that count as word characters.
_LETTER = re.compile(r"[^\W\d_]")
#: ASCII other than letters separates; bytes of other characters stay.
_LETTER_BYTES = bytes(b if 97 <= b <= 122 or b > 127 else 32 for b in range(256))

#: Families of languages by ISO 639-1 code; codes not listed form one more family.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is fo af fy lb yi",
    "romance": "fr es it pt ro ca gl oc",
    "slavic": "ru uk be pl cs sk bg sr hr bs sl mk",
    "baltic": "lt lv",
    "celtic": "ga gd cy br",
    "uralic": "fi et hu se",
    "turkic": "tr az kk ky uz tk tt ug",
    "indo-iranian": "hi ur bn pa gu mr ne si fa ps ku tg",
    "semitic": "ar he am mt",
    "dravidian": "ta te kn ml",
    "austronesian": "id ms tl jv su mg",
}


def family_of(language: str) -> str:
    code = re.split(r"[-_]", language.lower())[0]
    return next((name for name, codes in FAMILIES.items() if code in codes.split()), "other")


def held_out(doc_id: Column) -> Column:
    """Whether CRC-32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def counts_of(text: str) -> np.ndarray:
    """Counts of the hashed letter pairs and triples of the whole text."""
    out = np.zeros(DIMENSIONS, np.float32)
    for at in range(0, len(text), PIECE):
        piece = f" {text[at : at + PIECE].lower()} ".encode().translate(_LETTER_BYTES)
        b = np.frombuffer(b" ".join([b"", *piece.split(), b""]), np.uint8).astype(np.uint32)
        pairs = b[:-1] * np.uint32(257) + b[1:]
        triples = pairs[:-1] * np.uint32(257) + b[2:]
        for grams, salt in ((pairs, 0x9E3779B1), (triples, 0x85EBCA77)):
            slots = (grams * np.uint32(salt)) >> np.uint32(18)
            out += np.bincount(slots, minlength=DIMENSIONS)
    return out


def scaled(counts: np.ndarray) -> np.ndarray:
    """Square roots of the counts, at length 1."""
    root = np.sqrt(counts)
    return root / max(float(np.linalg.norm(root)), 1e-9)


def has_letter(text: str) -> bool:
    return any(sign.group().isalpha() for sign in _LETTER.finditer(text))


class Machine(NamedTuple):
    """A linear separator; positive margins stand for the first class."""

    first: int
    second: int
    bias: float


class Level(NamedTuple):
    """Classes in order, and a machine per pair with a row of weights each."""

    classes: list[str]
    machines: list[Machine]
    weights: np.ndarray

    def choose(self, x: np.ndarray) -> tuple[str, float]:
        """The class with most votes and the least certainty of its victories."""
        if len(self.classes) == 1:
            return self.classes[0], 1.0
        margins = self.weights @ x + np.array([m.bias for m in self.machines])
        votes, sums = np.zeros(len(self.classes)), np.zeros(len(self.classes))
        for m, margin in zip(self.machines, margins, strict=True):
            votes[m.first if margin >= 0 else m.second] += 1
            sums[m.first] += margin
            sums[m.second] -= margin
        best = max(range(len(self.classes)), key=lambda k: (votes[k], sums[k], -k))
        own = [margin if m.first == best else -margin for m, margin in zip(self.machines, margins, strict=True) if best in m[:2]]
        return self.classes[best], float(1 / (1 + np.exp(-2.0 * min(own))))


class Model(NamedTuple):
    families: Level
    languages: dict[str, Level]

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.languages or not has_letter(text):
            return UNKNOWN, 0.0
        x = scaled(counts_of(text))
        family, sure = self.families.choose(x)
        language, surer = self.languages[family].choose(x)
        return language, sure * surer


def support_vectors(x: np.ndarray, y: np.ndarray, c: float = 10.0, rounds: int = 20) -> tuple[np.ndarray, float]:
    """Weights and bias of a linear support vector machine, by coordinate descent on the dual."""
    x = np.hstack([x, np.ones((len(x), 1), np.float32)])
    norms, alpha, w = (x * x).sum(1), np.zeros(len(x)), np.zeros(x.shape[1], np.float32)
    order = np.random.default_rng(7)
    for _ in range(rounds):
        for i in order.permutation(len(x)):
            new = min(max(alpha[i] - (y[i] * float(w @ x[i]) - 1) / norms[i], 0.0), c)
            if new != alpha[i]:
                w += np.float32((new - alpha[i]) * y[i]) * x[i]
                alpha[i] = new
    return w[:-1], float(w[-1])


def level(x: np.ndarray, classes: np.ndarray) -> Level:
    names = sorted(set(classes))
    machines, weights = [], []
    for a, b in combinations(range(len(names)), 2):
        rows = (classes == names[a]) | (classes == names[b])
        w, bias = support_vectors(x[rows], np.where(classes[rows] == names[a], 1.0, -1.0))
        machines.append(Machine(a, b, bias))
        weights.append(w)
    return Level(names, machines, np.array(weights, np.float32).reshape(len(machines), DIMENSIONS))


def fit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", per_language: int = PER_LANGUAGE) -> Model:
    """A model of the rows that are not held out and have id, text and language."""
    key, name = F.col(f"`{doc_id}`"), F.col(f"`{lang}`").cast("string")
    rows = docs.select(key.alias("id"), name.alias("lang"), F.col(f"`{text}`").alias("text"))
    rows = rows.filter("id IS NOT NULL AND lang IS NOT NULL AND text IS NOT NULL").filter(~held_out(F.col("id")))
    # About twice the ids wanted pass a cut at a hash, each once, so that no language is ranked whole.
    slim = rows.select("id", "lang")
    totals = slim.groupBy("lang").agg(F.approx_count_distinct("id").alias("n"))
    place = F.pmod(F.xxhash64("id"), F.lit(1 << 30)) / F.lit(1 << 30)
    # The totals are a row per language, as few as the model's classes.
    drawn = slim.join(F.broadcast(totals), "lang").filter(place * F.col("n") < 2 * per_language + 50).select("id", "lang").distinct()
    order = Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id")
    chosen = drawn.withColumn("k", F.row_number().over(order)).filter(F.col("k") <= per_language)
    # At most per_language rows of each language are broadcast, and their counts collected.
    sample = rows.join(F.broadcast(chosen.select("id", "lang").distinct()), ["id", "lang"], "left_semi")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blobs = []
            for t in batch.column("text").to_pylist():
                c = counts_of(t)
                at = np.flatnonzero(c)
                blobs.append(at.astype(np.uint16).tobytes() + c[at].astype(np.float32).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("lang"), pa.array(blobs, pa.binary())], ["id", "lang", "counts"])

    kind = dict(rows.dtypes)["id"]
    taught = sample.mapInArrow(count, f"id {kind}, lang string, counts binary").dropDuplicates(["id", "lang"]).orderBy("lang", "id").collect()
    x = np.zeros((len(taught), DIMENSIONS), np.float32)
    for row, r in zip(x, taught, strict=True):
        n = len(r.counts) // 6
        row[np.frombuffer(r.counts[: 2 * n], np.uint16)] = np.frombuffer(r.counts[2 * n :], np.float32)
    x = np.array([scaled(row) for row in x]).reshape(len(taught), DIMENSIONS)
    languages = np.array([r.lang for r in taught], object)
    families = np.array([family_of(n) for n in languages], object)
    return Model(level(x, families), {f: level(x[families == f], languages[families == f]) for f in sorted(set(families))})


def identify(docs: DataFrame, model: Model, keep: list[str], text: str = "text") -> DataFrame:
    """The columns ``keep`` with ``lang_pred`` and ``score``."""
    shared = ship(docs.sparkSession.sparkContext, model)

    def start():
        predict = received(shared).predict

        def work(batch: pa.RecordBatch) -> list[pa.Array]:
            found = [predict(t.as_py()) for t in batch.column(text)]
            return [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())]

        return work

    return add_columns(docs, text, keep, RESULT, start)
