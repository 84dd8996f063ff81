"""Quality classifier: a byte-level convolutional network in numpy.

FILTERS learned filters of WIDTH bytes, each a table of weights per byte value and place, run over the whole text
every STRIDE bytes. Their rectified outputs are max-pooled over chunks of two half-chunks of POSITIONS places;
neighbouring chunks overlap by half and cover the text to its end. The largest and the mean chunk value of every
filter are combined into one probability by a logistic unit. Filters and the unit are learned together, by Adam
steps on the log loss, from a bounded sample: PER_CLASS documents per label, at most LONGEST characters each,
weighted back to the labels' true shares.

Texts are read in blocks, so memory doesn't grow with their length. Labels, lang, source and doc_id are no
inputs. Null and empty texts are WIDTH zero bytes. Without labels of both classes every score is the share of
good labels (1 without any label).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costloom.llm.labels import held_out, sample
from costloom.llm.words import texts

PER_CLASS = 1500
LONGEST = 12_000
FILTERS = 24
WIDTH = 8
STRIDE = 4
POSITIONS = 32
EPOCHS = 3
BATCH = 16
RATE = 0.01
BLOCK = 1 << 16
THRESHOLD = 0.3


class Network:
    """Weights: `table` (place, byte, filter), `shift` (filter), `out` (largest and mean per filter), `bias`."""

    def __init__(self, seed: int = 9) -> None:
        rng = np.random.default_rng(seed)
        self.table = rng.normal(0, 0.3, (WIDTH, 256, FILTERS)).astype(np.float32)
        self.shift = np.zeros(FILTERS, dtype=np.float32)
        self.out = rng.normal(0, 0.1, 2 * FILTERS).astype(np.float32)
        self.bias = 0.0
        self.constant: float | None = None

    def halves(self, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Largest rectified output per half-chunk and filter, and its byte offset."""
        values, places = [], []
        step = BLOCK // (STRIDE * POSITIONS) * STRIDE * POSITIONS
        for start in range(0, max(1, len(raw) - WIDTH + 1), step):
            part = raw[start : start + step + WIDTH - STRIDE]
            n = (len(part) - WIDTH) // STRIDE + 1
            total = self.table[0][part[0 : (n - 1) * STRIDE + 1 : STRIDE]]
            for j in range(1, WIDTH):
                total += self.table[j][part[j : j + (n - 1) * STRIDE + 1 : STRIDE]]
            total += self.shift
            np.maximum(total, 0, out=total)
            full = -n % POSITIONS
            if full:
                total = np.concatenate([total, np.zeros((full, FILTERS), np.float32)])
            grid = total.reshape(-1, POSITIONS, FILTERS)
            best = grid.argmax(axis=1)
            values.append(np.take_along_axis(grid, best[:, None, :], 1)[:, 0])
            places.append(start + (np.arange(len(grid))[:, None] * POSITIONS + best) * STRIDE)
        return np.concatenate(values), np.concatenate(places)

    def pooled(self, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Largest output per chunk and filter, and its byte offset. Chunk i is half-chunks i and i + 1."""
        value, place = self.halves(raw)
        if len(value) > 1:
            first = value[:-1] >= value[1:]
            value, place = np.where(first, value[:-1], value[1:]), np.where(first, place[:-1], place[1:])
        return value, place

    def score(self, text: bytes) -> float:
        if self.constant is not None:
            return self.constant
        value, _ = self.pooled(prepared(text))
        x = float(np.concatenate([value.max(0), value.mean(0)]) @ self.out) + self.bias
        return float(1 / (1 + np.exp(-np.clip(x, -30, 30))))


def prepared(text: bytes) -> np.ndarray:
    """Bytes with zeros up to a whole stride, so that the filters reach the last byte."""
    size = max(WIDTH, len(text) + -len(text) % STRIDE)
    return np.frombuffer(text.ljust(size, b"\0"), dtype=np.uint8)


def fit(rows: list[tuple[bytes, int]], share: float, seed: int = 9) -> Network:
    """Learn from (text, label); `share` is the true share of label 1."""
    net = Network(seed)
    ones = sum(label for _, label in rows)
    if not 0 < ones < len(rows):
        net.constant = float(share)
        return net
    weight = (len(rows) * (1 - share) / (len(rows) - ones), len(rows) * share / ones)
    rng = np.random.default_rng(seed)
    names = ("table", "shift", "out")
    first = {n: np.zeros_like(getattr(net, n)) for n in names} | {"bias": 0.0}
    second = {n: np.zeros_like(getattr(net, n)) for n in names} | {"bias": 0.0}
    step = 0
    total = EPOCHS * (len(rows) // BATCH + 1)
    data = [(prepared(t), y) for t, y in rows]
    channel = np.arange(FILTERS)
    for _ in range(EPOCHS):
        order = rng.permutation(len(data))
        for at in range(0, len(order), BATCH):
            grads = {n: np.zeros_like(getattr(net, n)) for n in names} | {"bias": 0.0}
            for k in order[at : at + BATCH]:
                raw, y = data[k]
                value, place = net.pooled(raw)
                top = value.argmax(0)
                vector = np.concatenate([value[top, channel], value.mean(0)])
                p = 1 / (1 + np.exp(-np.clip(float(vector @ net.out) + net.bias, -30, 30)))
                d = (p - y) * weight[y] / BATCH
                grads["out"] += d * vector
                grads["bias"] += d
                back = np.repeat((d * net.out[FILTERS:] / len(value))[None, :], len(value), 0)
                back[top, channel] += d * net.out[:FILTERS]
                back[value <= 0] = 0
                grads["shift"] += back.sum(0)
                flat = np.broadcast_to(channel, place.shape)
                for j in range(WIDTH):
                    cell = raw[place + j].astype(np.int64) * FILTERS + flat
                    grads["table"][j] += np.bincount(
                        cell.ravel(), weights=back.ravel(), minlength=256 * FILTERS
                    ).reshape(256, FILTERS)
            step += 1
            rate = RATE * (1 - step / (total + 1))
            for n in (*names, "bias"):
                first[n] = 0.9 * first[n] + 0.1 * grads[n]
                second[n] = 0.99 * second[n] + 0.01 * grads[n] ** 2
                move = rate * (first[n] / (1 - 0.9**step)) / (np.sqrt(second[n] / (1 - 0.99**step)) + 1e-7)
                setattr(net, n, getattr(net, n) - move)
            net.table = net.table.astype(np.float32, copy=False)
    return net


def scored(text: Column, net: Network) -> Column:
    """Score of a text column; the network travels with the tasks (200 kB, whatever the corpus)."""

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([net.score(x) for x in texts(batch)], pa.float64())

    return score(text)


def train(docs: DataFrame, labels: DataFrame) -> Network:
    open_ = labels.filter(~held_out(F.col("doc_id")) & F.col("quality").isin(0, 1))
    share = open_.agg(F.avg(F.col("quality").cast("double"))).first()[0]
    rows = sample(docs, labels, "quality", PER_CLASS, LONGEST).collect()
    return fit([(r["text"].encode(), r["label"]) for r in rows], 1.0 if share is None else share)


def quality_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""
    net = train(docs, labels)
    out = docs.select("doc_id", scored(F.col("text"), net).alias("score"))
    return out.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
