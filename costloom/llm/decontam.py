"""Benchmark decontamination by template canonicalisation.

Every word becomes a template token: numbers `<num>`, units `<unit>`, names (capitalised words) `<name>`, and
otherwise the word in lower case without punctuation at its ends. Names that stand together are one token, and so are
number words; punctuation and line feeds part them. A capitalised word that opens a sentence or a line is a name or
not: every text is read both ways, and a third time word by word. Windows of WIDTH tokens of documents and benchmark
items are joined, for each reading, on their hash and the template text; so a question comes up again after its
numbers and names were exchanged. The words in the slots (of names the last word) must then fit together: along one
alignment of item and document, each word of the item stands for one word of the document and the other way round.
Windows whose slot words are the same count even where others contradict them, so a verbatim passage is found next to a
changed one. Consistent windows of alignments at most NEAR tokens apart are taken together, so an added or lost
word doesn't part them. A document is contaminated if they cover MIN_RUN windows of an item, or all of a shorter item.

Before the join a bitmap of FILTER_BITS bits, built from the benchmark by a distributed aggregate, drops windows
whose hash no item has; its size is fixed, it never drops a match, and the exact join follows. Windows with
fewer than MIN_LITERALS literal tokens are too general for a template and are compared word by word only.

Items with fewer than WIDTH tokens are one window of their length, which is looked for anywhere in a document; items
with fewer than MIN_LITERALS only match documents that are no longer. Null texts count as empty; empty items match
nothing. Rows that share a doc_id are judged together; null ids share one verdict. Repeated items do no harm.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costloom.llm.storage import small, stored
from costloom.llm.words import REMEMBERED, mixed, texts, windows

WIDTH = 8
MIN_LITERALS = 4
#: Windows in a row that make a document contaminated: 13 words.
MIN_RUN = 6
#: Alignments so many tokens apart are taken together.
NEAR = 2
FILTER_BITS = 1 << 25
LAST = 2**63 - 1

# Units of measure and money.
UNITS = """
mm cm m km in inch inches ft foot feet yd yard yards mile miles g kg mg t ton tons oz lb lbs pound pounds
ml l liter liters litre litres gallon gallons s sec second seconds min minute minutes h hr hour hours day days
week weeks month months year years $ € £ % percent dollar dollars euro euros cent cents usd eur
km/h mph m/s kg/m3 hz khz mhz w kw j kj v a degree degrees °c °f
""".split()
_NUMBER = re.compile(r"[+-]?[$€£]?\d[\d.,]*(?:e[+-]?\d+)?%?$|[+-]?\d+/\d+$")
_WORD_NUMBERS = frozenset(
    "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen "
    "eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million".split()
)
_STRIP = ".,;:!?\"'()[]{}<>«»“”‘’*_`"
_KINDS = ("", "<num>", "<unit>", "<name>")
#: Readings: capitalised words that open a sentence are names, or are literals; all words are literals.
READINGS = ("names", "openers", "words")
#: Bits of a word besides its kind (the lowest two): it ends a sentence, is parted from the word behind it or before it
#: by punctuation, is a number word.
_END, _AFTER, _BEFORE, _SPELLED = 4, 8, 16, 32

_ENDS = frozenset(".!?:")
_UNITS = frozenset(UNITS)
_HASHES = np.array([xxhash.xxh3_64_intdigest(k.encode()) for k in _KINDS], dtype=np.uint64)
_SALTS = np.array([xxhash.xxh3_64_intdigest(k.encode()) for k in READINGS], dtype=np.uint64)
#: Bytes of text that are cut into words at once.
_BLOCK = 1_000_000
#: Classes of byte values; words with an odd byte may be numbers, or need Unicode's rules.
_SPACE, _PUNCTUATION, _QUOTE, _END_MARK, _CAPITAL, _ODD = (1 << i for i in range(6))


def _classes(value: int) -> int:
    char = chr(value)
    return (
        _SPACE * (char in " \t\n\v\f\r")
        | _PUNCTUATION * (value < 128 and char in _STRIP)
        | _QUOTE * (char in "\"')")
        | _END_MARK * (char in _ENDS)
        | _CAPITAL * ("A" <= char <= "Z")
        | _ODD * (value > 127 or char in "0123456789-")
    )


_CLASSES = bytes(map(_classes, range(256)))
# Literals are hashed as a polynomial in _BASE of one random value per byte, the same for both cases of a letter.
_REACH = 1 << 16
_BASE = 0x5851F42D4C957F2D
_VALUES = mixed(np.frombuffer(bytes(range(256)).lower(), np.uint8).astype(np.uint64), 1)


def _powers(base: int) -> np.ndarray:
    return np.cumprod(np.r_[np.uint64(1), np.full(_REACH - 1, base, np.uint64)])


_UP, _DOWN = _powers(_BASE), _powers(pow(_BASE, -1, 1 << 64))


def _runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the runs of a mask begin and end; the mask is false at both its ends."""
    edges = np.flatnonzero(mask[1:] != mask[:-1]) + 1
    return edges[::2], edges[1::2]


def _literal_hashes(text: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each stretch of bytes, ASCII letters in lower case; the stretches follow one another."""
    out, at = np.empty(len(starts), np.uint64), 0
    while at < len(starts):
        base = int(starts[at])
        upto = int(np.searchsorted(ends, base + _REACH, "right"))
        if upto == at:  # longer than the powers reach
            out[at] = xxhash.xxh3_64_intdigest(text[base : ends[at]].tobytes().lower())
            at += 1
            continue
        low, high = starts[at:upto] - base, ends[at:upto] - base
        sums = np.zeros(int(high[-1]) + 1, np.uint64)
        np.cumsum(_VALUES[text[base : base + len(sums) - 1]] * _UP[: len(sums) - 1], out=sums[1:])
        out[at:upto] = (sums[high] - sums[low]) * _DOWN[low]
        at = upto
    return mixed(out)


def _hashed(literals: list[bytes]) -> np.ndarray:
    ends = np.cumsum([len(x) for x in literals], dtype=np.int64)
    return _literal_hashes(np.frombuffer(b"".join(literals), np.uint8), np.r_[0, ends[:-1]], ends)


#: Words whose hash ends in 16 bits that are marked here may be units or number words.
_SPECIAL_BITS = np.zeros(1 << 16, dtype=bool)
_SPECIAL_BITS[_hashed([w.encode() for w in sorted(_UNITS | _WORD_NUMBERS)]) & np.uint64(0xFFFF)] = True


class Canon(dict):
    """Word to its number, of words that need a closer look; per number the hash of its literal, and its kind and other bits."""

    def __init__(self) -> None:
        self.literals: list[bytes] = []
        self.bits: list[int] = []
        self._arrays = (np.zeros(0, np.uint64), np.zeros(0, np.uint8))

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self.bits)
        raw = word.decode("utf-8", "replace")
        bare = raw.strip(_STRIP)
        low = bare.lower()
        spelled = low in _WORD_NUMBERS or "-" in low and _WORD_NUMBERS.issuperset(low.split("-"))
        if spelled or _NUMBER.match(low):
            bits = 1
        elif low in _UNITS:
            bits = 2
        else:
            bits = 3 if bare[:1].isupper() else 0
        bits |= _SPELLED * spelled | _AFTER * (raw[-1:] in _STRIP) | _BEFORE * (raw[:1] in _STRIP)
        bits |= _END * (raw.rstrip("\"'”’)»")[-1:] in _ENDS)
        self.literals.append((low or raw.lower()).encode())
        self.bits.append(bits)
        return number

    def look(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Hashes and bits of the words."""
        ids = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        hashes, bits = self._arrays
        done = len(hashes)
        if done < len(self.bits):
            hashes = np.concatenate([hashes, _hashed(self.literals)])
            bits = np.concatenate([bits, np.array(self.bits[done:], np.uint8)])
            self._arrays, self.literals = (hashes, bits), []
        return hashes[ids], bits[ids]


class Words:
    """The words of a text that begins and ends with a line feed: their places, the hashes of their literals, their bits.

    Words of ASCII characters without digits and hyphens are taken together; all others, and those that may be units or
    number words, are looked up one by one.
    """

    def __init__(self, text: bytes, known: Canon) -> None:
        self.text = text
        classes = np.frombuffer(text.translate(_CLASSES), np.uint8)
        self.starts, self.ends = starts, ends = _runs(classes & _SPACE == 0)
        final = ends - 1
        first, last = classes[starts], classes[final]
        before, after, quoted = first & _PUNCTUATION > 0, last & _PUNCTUATION > 0, last & _QUOTE > 0
        left, right = starts.copy(), ends.copy()
        begins, stops = _runs(classes & _PUNCTUATION > 0)
        left[before] = stops[np.searchsorted(stops, starts[before], "right")]
        right[after] = begins[np.searchsorted(begins, ends[after]) - 1]
        bare = left >= right
        left[bare], right[bare] = starts[bare], ends[bare]
        begins, _ = _runs(classes & _QUOTE > 0)
        final[quoted] = begins[np.searchsorted(begins, ends[quoted]) - 1] - 1
        self.hashes = _literal_hashes(np.frombuffer(text, np.uint8), left, right)
        self.bits = 3 * (classes[left] & _CAPITAL > 0) + _AFTER * after + _BEFORE * before + _END * (classes[final] & _END_MARK > 0)
        self.bits = self.bits.astype(np.uint8)
        odd = _SPECIAL_BITS[self.hashes & np.uint64(0xFFFF)]
        odd[np.searchsorted(starts, np.flatnonzero(classes & _ODD), "right") - 1] = True
        at = np.flatnonzero(odd)
        self.hashes[at], self.bits[at] = known.look([self.raw(i) for i in at.tolist()])

    def raw(self, i: int) -> bytes:
        return self.text[self.starts[i] : self.ends[i]]

    def literal(self, i: int) -> str:
        raw = self.raw(i).decode("utf-8", "replace")
        return (raw.strip(_STRIP) or raw).lower()


class Templates:
    """Template windows of texts, many at a time.

    Without a bitmap the texts are items. With one they are documents, and `short` holds, per reading, the
    lengths of the items that are shorter than a window.
    """

    def __init__(self, width: int, bits: np.ndarray | None, short: list[list[int]] | None = None) -> None:
        self.width, self.bits, self.short = width, bits, short or [[] for _ in READINGS]
        self.known = Canon()

    def _maybe(self, keys: np.ndarray) -> np.ndarray:
        if self.bits is None:
            return np.ones(len(keys), dtype=bool)
        slot = (keys & np.uint64(FILTER_BITS - 1)).astype(np.int64)
        return (self.bits[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 > 0

    def _row(self, reading: int, key: np.uint64, place: int, words: list[list[str]], kinds: list[int]) -> dict:
        return {
            "h": int(key.astype(np.int64)),
            "reading": reading,
            "size": len(words),
            "place": place,
            "template": f"{reading} " + " ".join(_KINDS[k] or w[0] for w, k in zip(words, kinds, strict=True)),
            "slots": [w[-1] if k == 3 else " ".join(w) for w, k in zip(words, kinds, strict=True) if k],
        }

    def find(self, raws: list[bytes]) -> list[dict]:
        """`n` (per reading, the usable windows of an item) and `found` of each text."""
        if len(self.known) > REMEMBERED:
            self.known = Canon()
        out = [{"n": [0] * len(READINGS), "found": []} for _ in raws]
        words = Words(b"\n" + b"\n".join(raws) + b"\n", self.known)
        total = len(words.starts)
        if not total:
            return out
        bits = words.bits
        lengths = np.array([len(r) + 1 for r in raws], dtype=np.int64)
        sizes = np.diff(np.searchsorted(words.starts, np.r_[1, 1 + np.cumsum(lengths)]))
        doc = np.repeat(np.arange(len(raws)), sizes)
        opens = np.zeros(total + 1, dtype=bool)
        opens[np.searchsorted(words.starts, np.flatnonzero(np.frombuffer(words.text, np.uint8) == 10))] = True
        opens = opens[:-1]
        parted = opens.copy()
        opens[1:] |= (bits[:-1] & _END) > 0
        parted[1:] |= (bits[:-1] & _AFTER) > 0
        parted |= (bits & _BEFORE) > 0
        kinds = bits & 3
        for reading, name in enumerate(READINGS):
            own = kinds if name == "names" else np.where(opens & (kinds == 3), 0, kinds) if name == "openers" else np.zeros_like(kinds)
            joins = np.zeros(total, dtype=bool)
            joins[1:] = ~parted[1:] & (
                (own[1:] == 3) & (own[:-1] == 3) | (own[1:] == 1) & (own[:-1] == 1) & ((bits[1:] & _SPELLED) > 0)
            )
            self._windows(reading, out, words, np.flatnonzero(~joins), own, doc)
        return out

    def _windows(
        self, reading: int, out: list[dict], words: Words, at: np.ndarray, kinds: np.ndarray, doc: np.ndarray
    ) -> None:
        """Add the windows of one reading; its tokens begin at the words `at`."""
        ends = np.append(at[1:], len(words.starts))
        kinds, doc = kinds[at], doc[at]
        hashes = np.where(kinds == 0, words.hashes[at], _HASHES[kinds])
        sizes = np.bincount(doc, minlength=len(out))
        first = np.cumsum(sizes) - sizes
        literal = np.concatenate([[0], np.cumsum(kinds == 0)])
        short = self.short[reading] if self.bits is not None else np.unique(sizes[(sizes > 0) & (sizes < self.width)]).tolist()
        for take in {self.width, *short}:
            n = len(at) - take + 1
            if n < 1:
                continue
            keys = windows(hashes, take) ^ _SALTS[reading]
            starts = np.flatnonzero(self._maybe(keys))
            usable = doc[starts] == doc[starts + take - 1]
            usable &= literal[starts + take] - literal[starts] >= min(MIN_LITERALS, take)
            if take < self.width and (self.bits is None or take < MIN_LITERALS):
                usable &= sizes[doc[starts]] == take
            for i in starts[usable].tolist():
                d = int(doc[i])
                tokens = [[words.literal(x) for x in range(at[j], ends[j])] for j in range(i, i + take)]
                out[d]["n"][reading] += 1
                out[d]["found"].append(self._row(reading, keys[i], i - int(first[d]), tokens, kinds[i : i + take].tolist()))


_ROW = "array<struct<h:bigint,reading:int,size:int,place:int,template:string,slots:array<string>>>"


def template_windows(
    text: Column, width: int = WIDTH, bitmap: bytes | None = None, short: list[list[int]] | None = None
) -> Column:
    """The template windows of a text column; with a bitmap only those it may contain, also of the `short` lengths."""
    share = None
    if bitmap is not None:
        from pyspark.sql import SparkSession

        share = SparkSession.active().sparkContext.broadcast(bitmap)

    @F.arrow_udf(f"struct<n:array<int>,found:{_ROW}>")
    def canonical(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        finder = Templates(width, None if share is None else np.frombuffer(share.value, dtype=np.uint8), short)
        for batch in batches:
            raws = texts(batch)
            out, at = [], 0
            while at < len(raws):
                upto, size = at, 0
                while upto < len(raws) and (upto == at or size + len(raws[upto]) <= _BLOCK):
                    size += len(raws[upto])
                    upto += 1
                out.extend(finder.find(raws[at:upto]))
                at = upto
            yield pa.array(out, type=_type())

    return canonical(text)


def _type() -> pa.DataType:
    row = pa.struct(
        [
            ("h", pa.int64()),
            ("reading", pa.int32()),
            ("size", pa.int32()),
            ("place", pa.int32()),
            ("template", pa.string()),
            ("slots", pa.list_(pa.string())),
        ]
    )
    return pa.struct([("n", pa.list_(pa.int32())), ("found", pa.list_(row))])


def _bitmap(items: DataFrame) -> bytes:
    """FILTER_BITS bits, set at the hashes of the items' windows; as large for any benchmark."""
    slot = F.col("h").bitwiseAND(F.lit(FILTER_BITS - 1))
    parts = (
        items.groupBy(F.shiftright(slot, 15).alias("part"))
        .agg(F.bitmap_construct_agg(slot.bitwiseAND(F.lit((1 << 15) - 1))).alias("bits"))
        .collect()
    )
    out = bytearray(FILTER_BITS // 8)
    for row in parts:
        out[row["part"] * 4096 : row["part"] * 4096 + 4096] = row["bits"]
    return bytes(out)


def _short(items: DataFrame, width: int) -> list[list[int]]:
    """Per reading the lengths of the items shorter than a window; at most `width` - 1 each."""
    out: list[list[int]] = [[] for _ in READINGS]
    for row in items.filter(F.col("size") < width).select("reading", "size").distinct().collect():
        out[row["reading"]].append(row["size"])
    return out


def matches(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """(id, item_id, reading, shift, places, consistent, verbatim, n_windows): one row per alignment that has a hit.

    `places` are the windows of the item that are hit, `verbatim` those with the same slot words.
    """
    items = stored(
        benchmark.select(F.coalesce(F.col("item_id").cast("long"), F.lit(LAST)).alias("item_id"), template_windows(F.col("text"), width).alias("w"))
        .select("item_id", F.col("w.n").alias("n"), F.inline("w.found"))
        .withColumn("n_windows", F.col("n")[F.col("reading")])
        .drop("n"),
        "items",
    )
    bitmap = _bitmap(items)
    own = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("id"),
        template_windows(F.col("text"), width, bitmap, _short(items, width))["found"].alias("found"),
    ).select("id", F.inline("found")).drop("size")
    sides = items.select(
        "item_id", "n_windows", "h", "template", F.col("place").alias("item_place"), F.col("slots").alias("item_slots")
    ).distinct()
    hits = stored(own.join(small(sides, 150_000), ["h", "template"]).distinct(), "hits")
    key = ["id", "item_id", "reading", "shift"]
    hits = hits.withColumn("shift", F.col("place") - F.col("item_place"))
    windows_ = hits.groupBy(*key).agg(
        F.collect_set("item_place").alias("places"),
        F.collect_set(F.when(F.col("slots") == F.col("item_slots"), F.col("item_place"))).alias("verbatim"),
        F.max("n_windows").alias("n_windows"),
    )
    pairs = hits.select(
        *key, F.explode_outer(F.arrays_zip(F.col("item_slots").alias("x"), F.col("slots").alias("y"))).alias("p")
    ).select(*key, "p.x", "p.y").distinct()
    ties = pairs.groupBy(*key).agg(
        F.count("x").alias("n_pairs"), F.count_distinct("x").alias("n_x"), F.count_distinct("y").alias("n_y")
    )
    fits = (F.col("n_pairs") == F.col("n_x")) & (F.col("n_pairs") == F.col("n_y"))
    return windows_.join(ties, key).select(*key, "places", fits.alias("consistent"), "verbatim", "n_windows")


def contaminated(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, min_run: int = MIN_RUN) -> DataFrame:
    """(id, items, n_windows): the contaminated documents, the items they hold and the windows that show it.

    The windows are those of the reading and place that show most of an item, summed over the items.
    """
    found = matches(docs, benchmark, width)
    key = ["id", "item_id", "reading"]
    around = F.explode(F.sequence(F.col("shift") - NEAR, F.col("shift") + NEAR)).alias("around")
    proofs = (
        found.withColumn("proof", F.when(F.col("consistent"), F.col("places")).otherwise(F.col("verbatim")))
        .filter(F.size("proof") > 0)
        .select(*key, "n_windows", "proof", around)
        .groupBy(*key, "around")
        .agg(F.size(F.array_distinct(F.flatten(F.collect_list("proof")))).alias("proof"), F.max("n_windows").alias("n_windows"))
    )
    return (
        proofs.filter(F.col("proof") >= F.least(F.lit(min_run), F.col("n_windows")))
        .groupBy("id", "item_id")
        .agg(F.max("proof").alias("proof"))
        .groupBy("id")
        .agg(
            F.array_sort(F.collect_set(F.when(F.col("item_id") != LAST, F.col("item_id")))).alias("items"),
            F.sum("proof").alias("n_windows"),
        )
    )


def contamination_report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, contaminated, items and n_windows of every row."""
    found = contaminated(docs, benchmark)
    rows = docs.select("doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("id"))
    none = F.array().cast("array<bigint>")
    return rows.join(found, "id", "left").select(
        "doc_id",
        F.col("items").isNotNull().alias("contaminated"),
        F.coalesce("items", none).alias("items"),
        F.coalesce("n_windows", F.lit(0)).cast("long").alias("n_windows"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of `docs` that hold no benchmark item."""
    gone = stored(contaminated(docs, benchmark).select(F.col("id").alias("_gone")), "contaminated")
    return docs.join(small(gone), F.coalesce(docs["doc_id"].cast("long"), F.lit(LAST)) == F.col("_gone"), "left_anti")
