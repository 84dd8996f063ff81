"""Spelling variant grouping: words one edit apart, found by Gram matrices of letter counts, and forms to follow.

Two words are near if one inserted, deleted or replaced code point turns one into the other. Then their lengths
differ by one at most, and the squared distance of their letter counts is at most two; that distance comes from one
NumPy product of the blocks' letter counts, and only pairs within it are compared letter by letter.

Blocks keep these products small without losing a pair. A block has a base length L and a span [i, j) of it: its
words have L or L + 1 letters and agree in the first i and the last L - j. One edit lies in one half of any
span, so each word goes to both halves of [0, L) for both of its base lengths, and a near pair meets in the half
that holds its first difference. A block with more than CROWDED words is split into its two half spans
again, and so on; a span of one letter leaves no more words than the alphabet has pairs, so this ends, and no word
or pair is dropped. Blocks with the same base are put together up to TILE words for one product; larger ones are
taken tile by tile. A pair counts only in the block whose span holds its first difference, so it counts once.

A word's form is its near word of largest count, if that count is at least RATIO times its own; following forms
to the last gives the root, by pointer jumping (counts grow tenfold with each step, so a few rounds are enough).

Results of edge cases: null and empty texts have no words. Repeated rows count as often as they occur. A null id
is the empty text in the hash. Ties of counts go to the smallest word in code-point order. An empty table, or one
without a word that occurs twice, gives no rows. Extra columns don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costloom.llm.storage import small, stored

RUN = "[A-Za-z\\u00C0-\\u00FF]"
SHORTEST = 7
LEAST = 2
RATIO = 10
#: One in this many occurrences loses a letter.
THINNED = 31
#: Blocks with more words are split again.
CROWDED = 4096
#: Words of one matrix product, and letters in its words at most.
TILE = 512
TILE_CELLS = 1 << 24
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_CODES = 256


def occurrences(docs: DataFrame) -> DataFrame:
    """`word` of every occurrence that has SHORTEST letters or more, thinned by the hash of id and word."""
    runs = F.regexp_extract_all("text", F.lit(f"({RUN}{{{SHORTEST},}})"), F.lit(1))
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
    plain = F.when(F.col("run").rlike("[\\u00C0-\\u00DE]"), F.translate("run", _UPPER, _UPPER.lower()))
    words = runs.select("id", plain.otherwise(F.lower("run")).alias("run"))
    hashed = words.select("run", F.crc32(F.encode(F.concat("id", F.lit(":"), "run"), "utf-8")).alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    less = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run")))
    word = F.when(F.col("h") % THINNED == 0, less).otherwise(F.col("run"))
    return hashed.select(word.alias("word")).filter(F.length("word") >= SHORTEST)


def vocabulary(docs: DataFrame) -> DataFrame:
    """(word, n) of the words with at least LEAST occurrences; counted in the tasks before the shuffle."""
    return occurrences(docs).groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= LEAST)


def _blocked(rows: DataFrame) -> DataFrame:
    """`key` of the block of each row: base length, span, and the letters outside the span."""
    head = F.substring(F.col("word"), F.lit(1), F.col("i"))
    tail_size = F.col("base") - F.col("j")
    tail = F.substring(F.col("word"), F.length("word") - tail_size + 1, tail_size)
    return rows.withColumn("key", F.xxhash64("base", "i", "j", head, tail))


def _halves(rows: DataFrame) -> DataFrame:
    """Each row once per half of its span."""
    middle = F.floor((F.col("i") + F.col("j")) / 2).cast("int")
    spans = F.array(
        F.struct(F.col("i").alias("i"), middle.alias("j")), F.struct(middle.alias("i"), F.col("j").alias("j"))
    )
    split = rows.select("word", "n", "base", F.explode(spans).alias("span"))
    return _blocked(split.select("word", "n", "base", "span.i", "span.j"))


def blocks(words: DataFrame, crowded: int = CROWDED) -> DataFrame:
    """(word, n, base, i, j, key): every word in its blocks, none with more than `crowded` words if it can be split."""
    size = F.length("word")
    both = words.select("word", "n", F.explode(F.array(size - 1, size)).alias("base"))
    level = _halves(both.select("word", "n", "base", F.lit(0).alias("i"), F.col("base").alias("j")))
    done = None
    while True:
        level = stored(level, "variants-level")
        hot = level.filter("j - i > 1").groupBy("key").count().filter(F.col("count") > crowded).select("key")
        hot = stored(hot, "variants-hot")
        if hot.isEmpty():
            return level if done is None else done.unionByName(level)
        hot = small(hot)
        cool = level.join(hot, "key", "left_anti")
        done = cool if done is None else done.unionByName(cool)
        level = _halves(level.join(hot, "key", "left_semi"))


def _letters(words: list[str], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Code points padded with zeros to `width`, and the letter counts in the columns that occur."""
    raw = b"".join(w.encode("latin-1").ljust(width, b"\0") for w in words)
    codes = np.frombuffer(raw, dtype=np.uint8).reshape(len(words), width)
    cells = np.arange(len(words))[:, None] * _CODES + codes
    counts = np.bincount(cells.ravel(), minlength=len(words) * _CODES).reshape(len(words), _CODES)
    counts[:, 0] = 0
    return codes, counts[:, counts.any(0)].astype(np.float32)


def _first_difference(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Place of the first difference of rows of equal width; the width where there is none."""
    other = a != b
    return np.where(other.any(1), other.argmax(1), a.shape[1])


def _near_in(codes: np.ndarray, long: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether the rows `left` (of base length) and `right` are one edit apart, and the place of the edit."""
    base = codes.shape[1] - 1
    a, b = codes[left], codes[right]
    first = _first_difference(a[:, :base], b[:, :base])
    replaced = ~long[right] & ((a != b).sum(1) == 1)
    moved = (a[:, :base] != b[:, 1:])[:, ::-1]
    last = np.where(moved.any(1), base - moved.argmax(1), 0)  # letters before it don't have to agree
    return replaced | (long[right] & (last <= first)), first


def _pairs(words: list[str], n: np.ndarray, base: int, i: np.ndarray, j: np.ndarray, key: np.ndarray) -> tuple:
    """Places of the near pairs (base length first) among words of one base length, sorted by key."""
    codes, counts = _letters(words, base + 1)
    long = codes[:, base] > 0
    short, norm = np.flatnonzero(~long), (counts * counts).sum(1)
    found = []
    tile = max(2, min(TILE, TILE_CELLS // (base + 1)))
    for start in range(0, len(short), tile):
        rows = short[start : start + tile]
        # Sorted by key: only words between the first and last key of these rows can share a block with them.
        low, high = np.searchsorted(key, key[rows[0]]), np.searchsorted(key, key[rows[-1]], "right")
        for at in range(low, high, tile):
            stop = min(at + tile, high)
            distance = norm[rows][:, None] + norm[None, at:stop] - 2 * (counts[rows] @ counts[at:stop].T)
            x, y = np.nonzero(distance <= 2)
            x, y = rows[x], y + at
            # One block, and pairs of equal length once.
            fit = (key[x] == key[y]) & (i[x] == i[y]) & (j[x] == j[y]) & (long[y] | (x < y))
            x, y = x[fit], y[fit]
            near, place = _near_in(codes, long, x, y)
            near &= (i[x] <= place) & ((place < j[x]) | ((place == base) & (j[x] == base)))
            found.append((x[near], y[near]))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows sorted by base and key as tables of whole blocks; several small blocks of one base together."""
    waiting: list[pa.RecordBatch] = []
    for batch in batches:
        waiting.append(batch)
        whole = pa.Table.from_batches(waiting)
        if len(whole) < TILE:
            continue
        base, key = whole["base"].to_numpy(), whole["key"].to_numpy()
        change = np.flatnonzero((base[1:] != base[:-1]) | (key[1:] != key[:-1])) + 1
        if not len(change):
            continue  # one block so far; CROWDED bounds it, or the alphabet
        yield from _tables(whole.slice(0, int(change[-1])), base[: change[-1]], change)
        waiting = whole.slice(int(change[-1])).combine_chunks().to_batches()
    if waiting:
        whole = pa.Table.from_batches(waiting)
        base, key = whole["base"].to_numpy(), whole["key"].to_numpy()
        yield from _tables(whole, base, np.flatnonzero((base[1:] != base[:-1]) | (key[1:] != key[:-1])) + 1)


def _tables(rows: pa.Table, base: np.ndarray, change: np.ndarray) -> Iterator[pa.Table]:
    """Cut at changes of base, and at ends of blocks after about TILE rows."""
    ends = change[change < len(rows)].tolist() + [len(rows)]
    start = 0
    for at, end in enumerate(ends):
        last = at + 1 == len(ends)
        if last or base[end] != base[start] or ends[at + 1] - start > TILE:
            if end - start > 1:
                yield rows.slice(start, end - start)
            start = end


def near_pairs(words: DataFrame, crowded: int = CROWDED) -> DataFrame:
    """(word, other, n, other_n) of all near pairs, each once, from a stored table (word, n)."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _batches(batches):
            text, n = part["word"].to_pylist(), part["n"].to_numpy()
            i, j, key = part["i"].to_numpy(), part["j"].to_numpy(), part["key"].to_numpy()
            x, y = _pairs(text, n, part["base"][0].as_py(), i, j, key)
            if len(x):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([text[p] for p in x]), pa.array([text[p] for p in y]), pa.array(n[x]), pa.array(n[y])],
                    ["word", "other", "n", "other_n"],
                )

    rows = blocks(words, crowded).repartition("base", "key").sortWithinPartitions("base", "key")
    return rows.mapInArrow(compare, "word string, other string, n long, other_n long")


def forms(words: DataFrame, pairs: DataFrame) -> DataFrame:
    """word, n, n_near, form and form_n of every word."""
    both = F.array(
        F.struct(F.col("word"), F.col("n"), F.col("other").alias("near"), F.col("other_n").alias("near_n")),
        F.struct(F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("near"),
                 F.col("n").alias("near_n")),
    )
    each = pairs.select(F.explode(both).alias("p")).select("p.*")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near"))).alias("best")
    near = each.groupBy("word").agg(F.count("*").alias("n_near"), best)
    joined = words.join(near, "word", "left")
    strong = -F.col("best.less") >= RATIO * F.col("n")
    return joined.select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(strong, F.col("best.near")).alias("form"),
        F.when(strong, -F.col("best.less")).alias("form_n"),
    )


def with_roots(table: DataFrame) -> DataFrame:
    """The column `root`: the last of the forms that follow a word, itself without one."""
    step = stored(table.filter("form is not null").select("word", F.col("form").alias("root")), "variants-roots")
    while True:
        ahead = step.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = step.join(ahead, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")
        )
        moved = stored(moved, "variants-roots")
        step = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            break
    return table.join(step, "word", "left").withColumn("root", F.coalesce(F.col("root"), F.col("word")))


def _flat(column: str) -> Column:
    return F.col(column).cast("long").alias(column)


def variant_report(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of the texts (columns doc_id and text)."""
    words = stored(vocabulary(docs.select("doc_id", "text")), "variants-words")
    table = stored(forms(words, near_pairs(words)), "variants-forms")
    return with_roots(table).select("word", "form", "root", _flat("n"), _flat("n_near"), _flat("form_n"))
