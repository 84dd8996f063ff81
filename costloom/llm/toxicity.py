"""Toxicity by multiple-instance learning.

A document is a bag of sentences. A sentence's probability is a logistic function of the sum of its words'
weights; a document's is the noisy-or, 1 - product of (1 - sentence probability). Only documents have labels;
the weights are fitted to them by gradient steps through the noisy-or, and then show which sentences offend.

A word's features are the word and its beginnings of 4, 5 and 6 characters, so inflected forms of a learned
stem count. Features are the VOCABULARY ones whose document frequencies differ most between the classes, by
z-score. Training takes a bounded sample: PER_CLASS documents per label, at most LONGEST characters each.
Features and weights are at most VOCABULARY pairs, whatever the corpus. Scoring takes whole texts.

Labels, lang, source and doc_id are no inputs of a score. Null and empty texts are one sentence without words.
Without labels of both classes the score is the same for all: the share of toxic labels, 0 without any.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costloom.llm.labels import held_out, sample

PER_CLASS = 4000
LONGEST = 50_000
VOCABULARY = 3000
MIN_DOCS = 5
STEPS = 400
BEGINNINGS = (4, 5, 6)
_SENTENCE = re.compile(r"[^.!?\n]+[.!?]*|[.!?]+")
_WORD = re.compile(r"\w+")
REMEMBERED = 300_000


def features(word: str) -> list[str]:
    return [word, *(f"{word[:n]}~" for n in BEGINNINGS if len(word) > n)]


def sentences(text: str) -> list[tuple[int, int]]:
    """Places of the sentences of a text; one empty sentence if there is none."""
    return [m.span() for m in _SENTENCE.finditer(text)] or [(0, 0)]


def _words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def choose(rows: list[tuple[str, int]]) -> list[str]:
    """Features whose document frequencies differ most between the labels."""
    counts = (Counter(), Counter())
    sizes = [0, 0]
    for text, label in rows:
        sizes[label] += 1
        counts[label].update({f for w in set(_words(text)) for f in features(w)})
    scored = []
    for name in counts[1].keys() | counts[0].keys():
        a, b = counts[1][name], counts[0][name]
        if a + b >= MIN_DOCS:
            p = (a + b + 1) / (sum(sizes) + 2)
            z = (a / sizes[1] - b / sizes[0]) / np.sqrt(p * (1 - p) * (1 / sizes[1] + 1 / sizes[0]))
            if z > 4:  # one in 30,000 by chance
                scored.append((-z, name))
    return [name for _, name in sorted(scored)[:VOCABULARY]]


class Model:
    """Weights of features, and the bias of a sentence."""

    def __init__(self, weights: dict[str, float], bias: float) -> None:
        self.weights = weights
        self.bias = bias
        self._known: dict[str, float] = {}

    def word(self, word: str) -> float:
        value = self._known.get(word)
        if value is None:
            if len(self._known) > REMEMBERED:
                self._known.clear()
            value = self._known[word] = float(sum(self.weights.get(f, 0.0) for f in features(word)))
        return value

    def score(self, text: str) -> tuple[float, list[tuple[int, int]]]:
        """Probability of a text, and the sentences of at least one half."""
        word, known = self.word, self._known
        places = sentences(text)
        quiet = float(np.log1p(-1 / (1 + np.exp(-self.bias))))
        clean, found = 0.0, []
        for a, b in places:
            total = 0.0
            for w in _words(text[a:b]):
                value = known.get(w)
                total += word(w) if value is None else value
            if total == 0.0:
                clean += quiet
                continue
            x = min(30.0, max(-30.0, self.bias + total))
            clean -= float(np.log1p(np.exp(x)))
            if x >= 0:
                found.append((a, b))
        return float(-np.expm1(clean)), found


def fit(rows: list[tuple[str, int]]) -> Model:
    """Weights that make the noisy-or of the sentences fit the documents' labels."""
    labels = np.array([label for _, label in rows], dtype=float)
    share = float(labels.mean()) if len(rows) else 0.0
    if not 0 < share < 1:
        return Model({}, 30.0 if share else -30.0)
    names = choose(rows)
    number = {n: i for i, n in enumerate(names)}
    cols, owner, bags, plain = [], [], [], np.zeros(len(rows))
    for k, (text, _) in enumerate(rows):
        for a, b in sentences(text):
            found = {number[f] for w in _words(text[a:b]) for f in features(w) if f in number}
            if found:
                cols.extend(found)
                owner.extend([len(bags)] * len(found))
                bags.append(k)
            else:
                plain[k] += 1
    col, own, bag = (np.array(x, dtype=np.int64) for x in (cols, owner, bags))
    weights, bias = np.zeros(len(names)), -4.0
    first, second = np.zeros(len(names) + 1), np.zeros(len(names) + 1)
    balance = np.where(labels == 1, 0.5 / labels.sum(), 0.5 / (len(labels) - labels.sum()))
    for step in range(1, STEPS + 1):
        x = bias + np.bincount(own, weights=weights[col], minlength=len(bags))
        p = 1 / (1 + np.exp(-x))
        p0 = 1 / (1 + np.exp(-bias))
        clean = plain * np.log1p(-p0) + np.bincount(bag, weights=-np.logaddexp(0, x), minlength=len(rows))
        prob = np.clip(-np.expm1(clean), 1e-9, 1 - 1e-9)
        # ascent on the balanced log-likelihood of 1 - exp(clean); d clean / d x is -p for every sentence
        slope = -balance * (labels * (1 - prob) / prob - (1 - labels))
        by = -slope[bag] * p
        up = np.append(
            np.bincount(col, weights=by[own], minlength=len(names)) - 1e-5 * weights,
            by.sum() - (slope * plain).sum() * p0,
        )
        first = 0.9 * first + 0.1 * up
        second = 0.999 * second + 0.001 * up**2
        move = 0.1 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        weights, bias = weights + move[:-1], min(-2.0, bias + float(move[-1]))
    return Model(dict(zip(names, weights.tolist(), strict=True)), float(bias))


def scored(text: Column, model: Model) -> Column:
    """score and spans (start:end of offending sentences, code points, comma-joined) of a text column."""
    weights, bias = model.weights, model.bias

    @F.arrow_udf("struct<score:double,spans:string>")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = Model(weights, bias)
        for batch in batches:
            found = [own.score(x or "") for x in batch.to_pylist()]
            spans = [",".join(f"{a}:{b}" for a, b in s) for _, s in found]
            yield pa.StructArray.from_arrays(
                [pa.array([s for s, _ in found], pa.float64()), pa.array(spans, pa.string())], names=["score", "spans"]
            )

    return score(text)


def train(docs: DataFrame, labels: DataFrame) -> Model:
    rows = sample(docs, labels, "toxic", PER_CLASS, LONGEST).collect()
    return fit([(r["text"], r["label"]) for r in rows])


def toxicity_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted and the offending sentences of every row."""
    model = train(docs, labels)
    out = docs.select("doc_id", scored(F.col("text"), model).alias("s"))
    return out.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        F.col("s.score").alias("score"),
        (F.col("s.score") >= 0.5).cast("int").alias("predicted"),
        F.col("s.spans").alias("spans"),
    )
