"""Quality rules with adaptive thresholds from mergeable quantile sketches per language and source.

Every document gets five counts and four measures made of them; none of them is its length, so a clean document is
not rejected for being long. For each (lang, source) and measure a sketch
counts the documents per logarithmic bucket (relative error ERROR); sketches merge by adding counts, so groups
with fewer than MIN_GROUP documents use the sketch of their language, merged over its sources, and
languages that small the sketch of everything. A measure's fences are its quartiles widened by SPREAD
times the interquartile distance, which is at least a stated floor; a document outside a fence goes. The
thresholds are joined back on (lang, source).

Counts are integers and buckets are a rule, so sketches don't depend on partitions or retries. A hot group is
summed before the shuffle and is one row per bucket after it. Null texts count as empty; empty documents fail the
base rules and enter no sketch. Null lang or source is a group of its own. Repeated rows are judged alike.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from costloom.llm.storage import columns, fresh, stored
from costloom.llm.words import texts

ERROR = 0.02
MIN_GROUP = 100
SPREAD = 4.0
WINDOW = 3
MIN_WORDS = 50
#: Measure: (smallest interquartile distance, fence below, fence above).
MEASURES = {
    "word_chars": (0.25, True, True),
    "symbols": (0.01, False, True),
    "dup_lines": (0.5, False, True),
    "repeats": (0.1, False, True),
}
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_SYMBOLS = b"#*$%&|<>"
_NOT_SYMBOLS = bytes(set(range(256)) - set(_SYMBOLS))
_CONTINUATION = bytes(range(0x80, 0xC0))
_BLANKS = b" \t\n\x0b\x0c\r"
_LOG = float(np.log((1 + ERROR) / (1 - ERROR)))


def _repeated(words: list[bytes]) -> int:
    """Words that lie in a window of three words found at least twice."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    if len(number) == len(words):
        return 0
    size = len(number)
    if size < 2_000_000:
        keys = (ids[:n] * size + ids[1 : n + 1]) * size + ids[2 : n + 2]
    else:
        pair = np.unique(ids[:n] * size + ids[1 : n + 1], return_inverse=True)[1]
        keys = pair * size + ids[2 : n + 2]
    _, back, times = np.unique(keys, return_inverse=True, return_counts=True)
    hit = times[back] > 1
    if not hit.any():
        return 0
    covered = np.zeros(len(words), dtype=bool)
    for i in range(WINDOW):
        covered[i : n + i] |= hit
    return int(covered.sum())


def _dup_lines(text: bytes) -> int:
    lines = [x for x in text.split(b"\n") if x.strip(_BLANKS)]
    return len(lines) - len(set(lines))


def _count(raw: bytes) -> tuple[int, int, int, int, int]:
    words = raw.split()
    chars = len(b"".join(words).translate(None, _CONTINUATION))
    return len(words), chars, len(raw.translate(None, _NOT_SYMBOLS)), _dup_lines(raw), _repeated(words)


def counts_of(text: Column) -> Column:
    """The five counts of a text column, as a struct."""

    @F.arrow_udf(f"struct<{','.join(c + ':bigint' for c in COUNTS)}>")
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            found = np.array([_count(t) for t in texts(batch)], dtype=np.int64).reshape(-1, len(COUNTS))
            yield pa.StructArray.from_arrays([pa.array(found[:, i]) for i in range(len(COUNTS))], names=list(COUNTS))

    return count(text)


def _measures(c: Column) -> dict[str, Column]:
    words = F.when(c["n_words"] > 0, c["n_words"]).cast("double")
    return {
        "word_chars": c["word_chars"] / words,
        "symbols": c["n_symbols"] / words,
        "dup_lines": c["n_dup_lines"] / words * 50,
        "repeats": c["n_repeat_words"] / words,
    }


def _bucket(value: Column) -> Column:
    """Bucket b holds values in (g^(b-1), g^b]; null stands for zero."""
    return F.when(value > 0, F.ceil(F.round(F.log(value) / _LOG, 9)).cast("int"))


def _value(bucket: Column) -> Column:
    """The middle of a bucket."""
    return F.when(bucket.isNull(), 0.0).otherwise(F.exp(bucket * _LOG) * (2 / (1 + float(np.exp(_LOG)))))


def sketches(counted: DataFrame) -> DataFrame:
    """(lang, source, measure, bucket, n) of documents that have words. `counted`: lang, source, c (counts)."""
    pairs = F.array(
        *[F.struct(F.lit(k).alias("measure"), _bucket(v).alias("bucket")) for k, v in _measures(F.col("c")).items()]
    )
    return (
        counted.filter("c.n_words > 0")
        .select("lang", "source", F.inline(pairs))
        .groupBy("lang", "source", "measure", "bucket")
        .agg(F.count("*").alias("n"))
    )


def _fences(sketch: DataFrame, by: list[str]) -> DataFrame:
    """Quartile fences of merged sketches: by, total, and lo / hi per measure."""
    merged = sketch.groupBy(*by, "measure", "bucket").agg(F.sum("n").alias("n"))
    order = Window.partitionBy(*by, "measure").orderBy(F.col("bucket").asc_nulls_first())
    every = Window.partitionBy(*by, "measure")
    ranked = merged.withColumn("upto", F.sum("n").over(order)).withColumn("total", F.sum("n").over(every))

    def quantile(q: float) -> Column:
        return F.min(F.when(F.col("upto") >= q * F.col("total"), F.struct(F.col("upto"), _value(F.col("bucket")).alias("at"))))["at"]

    quartiles = ranked.groupBy(*by, "measure").agg(
        F.max("total").alias("total"), quantile(0.25).alias("q1"), quantile(0.75).alias("q3")
    )
    floor = F.create_map(*[x for k, v in MEASURES.items() for x in (F.lit(k), F.lit(v[0]))])
    wide = SPREAD * F.greatest(F.col("q3") - F.col("q1"), F.element_at(floor, F.col("measure")))
    limits = quartiles.select(*by, "total", "measure", (F.col("q1") - wide).alias("lo"), (F.col("q3") + wide).alias("hi"))
    return limits.groupBy(*by).agg(
        F.max("total").alias("total"),
        F.map_from_entries(F.collect_list(F.struct("measure", F.struct("lo", "hi")))).alias("fences"),
    )


def thresholds(sketch: DataFrame, min_group: int = MIN_GROUP) -> DataFrame:
    """(lang, source, fences): of the group itself, or of its language, or of all, by number of documents."""
    group = _fences(sketch, ["lang", "source"])
    lang = _fences(sketch, ["lang"]).select(
        F.col("lang").alias("lang_"), F.col("total").alias("lang_total"), F.col("fences").alias("lang_fences")
    )
    everything = F.lit(None).cast("string")
    whole = _fences(sketch.withColumn("all", everything), ["all"]).select("fences").scalar()  # one row
    joined = group.join(lang, group["lang"].eqNullSafe(lang["lang_"])).withColumn("all_fences", whole)
    return joined.select(
        "lang",
        "source",
        F.when(F.col("total") >= min_group, F.col("fences"))
        .when(F.col("lang_total") >= min_group, F.col("lang_fences"))
        .otherwise(F.col("all_fences"))
        .alias("fences"),
    )


def _verdict(c: Column, fences: Column) -> tuple[Column, Column]:
    failed = (c["n_words"] < MIN_WORDS) | (100 * c["n_repeat_words"] > 50 * c["n_words"])
    inside = F.lit(True)
    for name, value in _measures(c).items():
        _, below, above = MEASURES[name]
        limit = F.element_at(fences, F.lit(name))
        if below:
            inside = inside & (value >= limit["lo"])
        if above:
            inside = inside & (value <= limit["hi"])
    return failed, F.when(failed, False).otherwise(F.coalesce(inside, F.lit(True)))


def judge(docs: DataFrame, min_group: int = MIN_GROUP) -> DataFrame:
    """doc_id, the counts, base_failed and kept of every row."""
    counted = stored(docs.select("doc_id", "lang", "source", counts_of(F.col("text")).alias("c")), "counts")
    limits = thresholds(sketches(counted), min_group)
    joined = counted.join(
        limits.select(F.col("lang").alias("lang_"), F.col("source").alias("source_"), "fences"),
        counted["lang"].eqNullSafe(F.col("lang_")) & counted["source"].eqNullSafe(F.col("source_")),
        "left",
    )
    failed, kept = _verdict(F.col("c"), F.col("fences"))
    return joined.select("doc_id", "c.*", failed.alias("base_failed"), kept.alias("kept"))


def keep_good(docs: DataFrame, min_group: int = MIN_GROUP) -> DataFrame:
    """The rows of `docs` that pass, with their columns."""
    c, lang, source, fences = (fresh(docs, x) for x in ("_c", "_lang", "_source", "_fences"))
    # Counted once for the thresholds and once for the verdicts: storing the texts with their counts takes as much disk
    # as the corpus, and rows have no key of their own to join stored counts to.
    counted = docs.select(docs["lang"].alias("lang"), docs["source"].alias("source"), counts_of(docs["text"]).alias("c"))
    limits = stored(thresholds(stored(sketches(counted), "sketches"), min_group), "thresholds")
    ready = docs.withColumn(c, counts_of(docs["text"]))
    joined = ready.join(
        limits.select(F.col("lang").alias(lang), F.col("source").alias(source), F.col("fences").alias(fences)),
        ready["lang"].eqNullSafe(F.col(lang)) & ready["source"].eqNullSafe(F.col(source)),
        "left",
    )
    _, kept = _verdict(F.col(c), F.col(fences))
    return joined.filter(kept).select(*columns(ready)[: len(docs.columns)])
