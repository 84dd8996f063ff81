"""Language ID by a string kernel: blended-spectrum presence, Nystrom landmarks, one-versus-rest kernel ridge regression.

A text is lower-cased, every run of other characters than letters becomes one blank, and a blank goes before and
behind. Its n-grams of one to LONGEST_GRAM characters are marked as present or absent (counts don't matter); they
are hashed into BUCKETS buckets. The kernel of two texts is the number of n-grams that both have, over the root of
the product of their numbers, among the n-grams that the landmarks have.

LANDMARKS texts, the same number of each language, stand for the kernel matrix (Nystrom): a text's features are its
kernel values with the landmarks times the inverse root of the landmarks' own kernel matrix. Ridge regression on
these features, one language against the rest and every language of equal weight, is fitted in the driver to a sample:
at most PER_LANGUAGE documents of each language, of at most LONGEST characters each, with the smallest hashes. Long
texts have nearly all n-grams and short ones few, so each sampled document also gives passages of SNIPPETS characters.
Scoring covers whole texts: presence in blocks of a batch, times the landmarks' n-grams, times the coefficients.

Results of edge cases: null texts and texts without a letter get `und` and score 0, and so does every text if no
document has a language to learn. With one learned language all others get that one. Only rows with an id take part
in learning; null languages teach nothing. Of more than LANGUAGES languages the most frequent are learned. Repeated
rows and extra columns don't matter; equal scores go to the smaller language name. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LONGEST_GRAM = 3
BUCKETS = 1 << 20
LANDMARKS = 192
LANGUAGES = 500
#: Documents of the sample: per language, and their longest length in characters.
PER_LANGUAGE = 150
LONGEST = 4000
SNIPPETS = (12, 30, 80, 300)
RIDGE = 1e-2
#: Texts of one matrix product, and characters of them at a time.
BATCH = 64
BLOCK = 1 << 18
UNKNOWN = "und"
_FIRST = 0x10000
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _folding() -> np.ndarray:
    """Code point to lower-case letter, or to a blank; for the first plane."""
    table = np.full(_FIRST, 32, dtype=np.uint32)
    for code in range(_FIRST):
        char = chr(code)
        if char.isalpha():
            lower = char.lower()
            table[code] = ord(lower) if len(lower) == 1 and ord(lower) < _FIRST else code
    return table


def _grams(folded: np.ndarray, owner: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per length of n-grams: owner, bucket, and whether all its characters belong to one text."""
    codes = folded.astype(np.uint64)
    total = np.zeros(len(codes), dtype=np.uint64)
    for n in range(1, LONGEST_GRAM + 1):
        m = len(codes) - n + 1
        if m <= 0:
            return
        total = (total[:m] + codes[n - 1 :]) * _STEP
        bucket = ((total ^ (total >> np.uint64(29))) * _STEP) >> np.uint64(44)
        yield owner[:m], bucket.view(np.int64), owner[:m] == owner[n - 1 :]


class Kernel:
    """Marks n-grams of texts; `column` is the place of a bucket among the landmarks' ones, or -1."""

    def __init__(self, column: np.ndarray | None = None, width: int = 0) -> None:
        self.column, self.width = np.full(BUCKETS, -1, np.int32) if column is None else column, width
        self._fold: np.ndarray | None = None

    def __getstate__(self) -> dict:
        return {"column": self.column, "width": self.width, "_fold": None}

    def buckets(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(text, bucket, whether it counts) of all n-grams, in blocks of about BLOCK characters."""
        pending: list[tuple[int, str]] = []
        size = 0
        for at, text in enumerate(texts):
            if len(text) > BLOCK:
                yield from self._long(at, text)
                continue
            pending.append((at, f" {text} "))
            size += len(text)
            if size >= BLOCK:
                yield from self._joined(pending)
                pending, size = [], 0
        if pending:
            yield from self._joined(pending)

    def _folded(self, text: str) -> np.ndarray:
        if self._fold is None:
            self._fold = _folding()
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        far = codes >= _FIRST
        if not far.any():
            return self._fold[codes]
        return np.where(far, codes, self._fold[np.where(far, 32, codes)])

    def _joined(self, texts: list[tuple[int, str]]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        folded = self._folded("".join(t for _, t in texts))
        owner = np.repeat(np.array([at for at, _ in texts], np.int64), [len(t) for _, t in texts])
        blank = folded == 32
        keep = np.ones(len(folded), bool)
        keep[1:] = ~(blank[1:] & blank[:-1]) | (owner[1:] != owner[:-1])
        yield from _grams(folded[keep], owner[keep])

    def _long(self, at: int, text: str) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """One text in pieces; each starts with the last characters of the one before."""
        before = np.array([32], np.uint32)
        for start in range(0, len(text), BLOCK):
            piece = text[start : start + BLOCK] + (" " if start + BLOCK >= len(text) else "")
            folded = np.concatenate([before, self._folded(piece)])
            blank = folded == 32
            keep = np.ones(len(folded), bool)
            keep[1:] = ~(blank[1:] & blank[:-1])
            folded = folded[keep]
            yield from _grams(folded, np.full(len(folded), at, np.int64))
            before = folded[-LONGEST_GRAM:]

    def presence(self, texts: list[str]) -> np.ndarray:
        """Texts by n-grams: 1 over the root of the text's number of n-grams where one is present."""
        marks = np.zeros((len(texts), self.width), dtype=np.float32)
        flat = marks.reshape(-1)
        for row, bucket, whole in self.buckets(texts):
            place = self.column[bucket]
            known = np.flatnonzero(whole & (place >= 0))
            flat[row[known] * self.width + place[known]] = 1
        norm = np.sqrt(np.maximum(marks.sum(1), 1))
        marks /= norm[:, None]
        return marks


@dataclass
class Model:
    """`landmarks` (n-gram by landmark) and `weights` (landmark by language)."""

    kernel: Kernel
    landmarks: np.ndarray
    weights: np.ndarray
    languages: list[str]

    def scores(self, texts: list[str]) -> np.ndarray:
        """Texts by languages."""
        return (self.kernel.presence(texts) @ self.landmarks) @ self.weights

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        names, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
        if not self.languages:
            return names, score
        able = [k for k, t in enumerate(texts) if t and any(map(str.isalpha, t))]
        for start in range(0, len(able), BATCH):
            part = able[start : start + BATCH]
            values = self.scores([texts[k] for k in part])
            best = values.argmax(1)
            score[part] = np.clip((values[np.arange(len(part)), best] + 1) / 2, 0, 1)
            for k, b in zip(part, best, strict=True):
                names[k] = self.languages[b]
        return names, score


def passages(text: str) -> list[str]:
    """A text and passages of it of several lengths, each from another place."""
    out = [text]
    for k, size in enumerate(SNIPPETS):
        if len(text) > size:
            start = (len(text) - size) * (2 * k + 1) // (2 * len(SNIPPETS))
            out.append(text[start : start + size])
    return out


def fit(rows: list[tuple[str, str]]) -> Model:
    """Learn from (text, language)."""
    rows = [(t, lang) for t, lang in rows if any(map(str.isalpha, t))]
    languages = sorted({lang for _, lang in rows})
    if not rows:
        return Model(Kernel(), np.zeros((0, 0)), np.zeros((0, 0)), [])
    marks_of: dict[str, list[str]] = {lang: [] for lang in languages}
    for text, lang in rows:
        if len(marks_of[lang]) < max(1, LANDMARKS // len(languages)):
            marks_of[lang].append(text)
    chosen = [t for lang in languages for t in marks_of[lang]]
    seen = np.zeros(BUCKETS, bool)
    for _, bucket, whole in Kernel().buckets(chosen):
        seen[bucket[whole]] = True
    column = np.full(BUCKETS, -1, np.int32)
    column[seen] = np.arange(int(seen.sum()))
    kernel = Kernel(column, int(seen.sum()))
    landmarks = np.ascontiguousarray(kernel.presence(chosen).T)
    own = (landmarks.T @ landmarks).astype(np.float64)
    values, vectors = np.linalg.eigh(own)
    keep = values > 1e-6 * values.max()
    root = vectors[:, keep] / np.sqrt(values[keep])
    samples = [(p, lang) for t, lang in rows for p in passages(t) if any(map(str.isalpha, p))]
    place = {lang: k for k, lang in enumerate(languages)}
    owner = np.array([place[lang] for _, lang in samples])
    weight = len(samples) / (len(languages) * np.bincount(owner, minlength=len(languages)))[owner]
    left, right = np.zeros((root.shape[1], root.shape[1])), np.zeros((root.shape[1], len(languages)))
    for start in range(0, len(samples), BATCH):
        part = slice(start, start + BATCH)
        x = (kernel.presence([t for t, _ in samples[part]]) @ landmarks) @ root
        y = np.where(owner[part][:, None] == np.arange(len(languages)), 1.0, -1.0)
        left += (x * weight[part][:, None]).T @ x
        right += (x * weight[part][:, None]).T @ y
    left[np.diag_indices_from(left)] += RIDGE * len(samples) / len(languages)
    weights = root @ np.linalg.solve(left, right)
    return Model(kernel, landmarks, weights.astype(np.float32), languages)


def held_out(doc_id: Column) -> Column:
    """Documents that nothing is learned from: crc32 of the id as text leaves 2 when divided by four."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def sample(docs: DataFrame) -> list[tuple[str, str]]:
    """At most PER_LANGUAGE (text, lang) of each language, those with the smallest hashes of id and text.

    A language's documents are first thinned by their count to about twice that number, so no task sorts a whole
    language. Languages with few short documents give what they have.
    """
    open_ = docs.filter(
        F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))
        & (F.length("text") <= LONGEST) & F.col("text").rlike(r"\p{L}")
    ).select("doc_id", "lang", "text", F.xxhash64("doc_id", F.lit("language")).alias("order"))
    counts = open_.groupBy("lang").count().orderBy(F.col("count").desc(), "lang").limit(LANGUAGES).collect()
    if not counts:
        return []
    share = docs.sparkSession.createDataFrame(
        [(r["lang"], min(1.0, 2 * (PER_LANGUAGE + 20) / r["count"])) for r in counts], "lang string, share double"
    )
    range_ = F.lit(2.0**63)
    thin = open_.join(F.broadcast(share), "lang").filter(F.col("order") / range_ < 2 * F.col("share") - 1)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("order", "doc_id", "text"))
    rows = thin.withColumn("rank", rank).filter(F.col("rank") <= PER_LANGUAGE).select("lang", "rank", "text").collect()
    return [(r["text"], r["lang"]) for r in sorted(rows, key=lambda r: (r["rank"], r["lang"]))]


def train(docs: DataFrame) -> Model:
    return fit(sample(docs))


def predicted(text: Column, model: Model) -> Column:
    """Struct (lang_pred, score) of a text column."""

    @F.arrow_udf("lang_pred string, score double")
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            names, score = model.predict(batch.to_pylist())
            yield pa.StructArray.from_arrays(
                [pa.array(names, pa.string()), pa.array(score, pa.float64())], ["lang_pred", "score"]
            )

    return predict(text)


def language_report(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row."""
    model = train(docs.select("doc_id", "text", "lang"))
    out = docs.select("doc_id", predicted(F.col("text"), model).alias("p"))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "p.lang_pred", "p.score")
