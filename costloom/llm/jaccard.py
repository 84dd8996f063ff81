"""N-gram Jaccard join with prefixes under several global token orders.

A document is the set of its different 3-word shingles (words lower-cased in A-Z; a text with fewer words is
one shingle; without words the set is empty and links with nothing). Two documents link when
100 * |A and B| >= 90 * |A or B|. The result is the connected component of every document.

If two sets of a and b tokens link, then under any global order of all tokens the first
a - ceil(0.9 a) + 1 tokens of one and the first b - ceil(0.9 b) + 1 of the other share a token. Three orders
are used, and a pair is verified only if its prefixes meet under all three:

* Order 1 puts a fixed fifth of the token space first, rarest tokens first; document frequencies are counted
  over all documents for that fifth. It generates the candidates: most documents have only tokens of their
  own in this prefix and are out at once, without any pair.
* Orders 2 and 3 are two independent hash orders, computed where the texts are.

Two more bounds thin out the candidates where they meet: the places of the shared token in both sets, and a
512-bit parity map of each set (two maps never differ in more bits than the sets differ in tokens).

Documents with equal sets are one class from the start. A candidate bucket (the classes that share a prefix
token) isn't expanded into pairs: each round compares its members with one pivot, links are merged into
components, and only buckets that still hold several components go on. What is left after the rounds, members
of different components of one bucket that pass all bounds, is compared in full, so no link between different
texts is lost. Sets are made, and stored once, only of documents that stand in such a pair; the others' sets are never
written or moved.

Null texts have no words. Rows that share a doc_id are one document; rows without an id are one document too,
and their component is null unless they link with a document that has one. Extra columns don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costloom.llm.components import connected
from costloom.llm.storage import small, stored
from costloom.llm.words import WordHashes, lists, mixed, texts, windows

LAST = 2**63 - 1
WIDTH = 3
PERCENT = 90
#: Tokens whose mixed hash is below this share of 256 come first in order 1.
FIRST_SHARE = 52
#: Rounds with a pivot per bucket before what is left is compared in full.
ROUNDS = 3
#: Fewer undecided pairs than this are compared at once.
FEW_PAIRS = 50_000
MAP_BITS = 512


def prefix_length(n: int, percent: int = PERCENT) -> int:
    return n - (percent * n + 99) // 100 + 1


def _sets(column: pa.Array, known: WordHashes, width: int) -> list[np.ndarray]:
    """Sorted different shingle hashes of each text."""
    get = known.__getitem__
    out = []
    for text in texts(column):
        words = text.lower().split()
        hashes = np.fromiter(map(get, words), np.uint64, len(words))
        out.append(np.unique(windows(hashes, width)))
    return out


def _signature(tokens: np.ndarray) -> tuple[int, int]:
    value = xxhash.xxh3_128_intdigest(tokens.tobytes())
    return np.uint64(value >> 64).astype(np.int64), np.uint64(value & (2**64 - 1)).astype(np.int64)


def _parity_map(tokens: np.ndarray) -> np.ndarray:
    counts = np.bincount((mixed(tokens, 17) & np.uint64(MAP_BITS - 1)).astype(np.int64), minlength=MAP_BITS)
    return np.packbits((counts & 1).astype(np.uint8)).view(np.uint64)


def _first_udf(width: int, percent: int):
    @F.arrow_udf("struct<n:bigint,s1:bigint,s2:bigint,first:array<bigint>,rest:array<bigint>,map:array<bigint>>")
    def first_tokens(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        """Size and signature of each set, its tokens of the first class, and what its prefix needs beyond."""
        known = WordHashes()
        for batch in batches:
            sets = _sets(batch, known, width)
            signatures = [_signature(s) for s in sets]
            first, rest = [], []
            for tokens in sets:
                order = mixed(tokens, 7)
                chosen = (order & np.uint64(255)) < FIRST_SHARE
                first.append(tokens[chosen])
                lacking = max(0, prefix_length(len(tokens), percent) - len(first[-1])) if len(tokens) else 0
                others = np.argsort(order[~chosen])[:lacking]
                rest.append(tokens[~chosen][others])
            yield pa.StructArray.from_arrays(
                [
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([s[0] for s in signatures], pa.int64()),
                    pa.array([s[1] for s in signatures], pa.int64()),
                    lists(first),
                    lists(rest),
                    lists([_parity_map(s) for s in sets]),
                ],
                names=["n", "s1", "s2", "first", "rest", "map"],
            )

    return first_tokens


def _prefix_udf(width: int, percent: int):
    @F.arrow_udf("struct<n:bigint,s1:bigint,s2:bigint,tokens:array<bigint>,p2:array<bigint>,p3:array<bigint>>")
    def prefixes(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        """Size, signature, the set and its prefixes under orders 2 and 3."""
        known = WordHashes()
        for batch in batches:
            sets = _sets(batch, known, width)
            signatures = [_signature(s) for s in sets]
            both = [
                [s[np.argsort(mixed(s, seed))[: prefix_length(len(s), percent)]] if len(s) else s for s in sets]
                for seed in (11, 13)
            ]
            yield pa.StructArray.from_arrays(
                [
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([s[0] for s in signatures], pa.int64()),
                    pa.array([s[1] for s in signatures], pa.int64()),
                    lists(sets),
                    lists(both[0]),
                    lists(both[1]),
                ],
                names=["n", "s1", "s2", "tokens", "p2", "p3"],
            )

    return prefixes


def _buckets(classes: DataFrame, percent: int) -> DataFrame:
    """(t, id, n, place, map) for every prefix token under order 1 that two documents share.

    n, place and map are null where rows of one id have different texts; no bound holds for these.
    """
    tokens = classes.select("id", F.explode("first").alias("t"))
    df = tokens.groupBy("t").agg(F.count("*").alias("df")).filter("df > 1")
    shared = tokens.join(df, "t").groupBy("id").agg(F.collect_list(F.struct("df", "t")).alias("shared"))
    meta = classes.groupBy("id").agg(
        F.max("n").alias("n"),
        F.max(F.size("first")).alias("n_first"),
        F.count("*").alias("texts"),
        F.flatten(F.collect_list("rest")).alias("rest"),
        F.first("map").alias("map"),
    )
    length = F.col("n") - F.floor((percent * F.col("n") + 99) / 100) + 1
    alone = F.col("n_first") - F.size("shared")
    one = F.col("texts") == 1
    open_ = F.when(one, F.greatest(length - F.col("alone"), F.lit(0))).otherwise(F.size("shared"))
    none = F.array().cast("array<struct<df:bigint,t:bigint>>")

    def placed(tokens: Column, start: Column) -> Column:
        return F.transform(tokens, lambda t, i: F.struct(t.alias("t"), (start + i).alias("place")))

    prefix = (
        meta.join(shared, "id", "left")
        .withColumn("shared", F.sort_array(F.coalesce("shared", none)))
        .withColumn("alone", alone)
        .withColumn("head", F.slice("shared", F.lit(1), open_.cast("int")))
        .select(
            "id",
            "n",
            "map",
            "texts",
            F.inline(
                F.concat(
                    placed(F.transform("head", lambda x: x["t"]), F.col("alone")),
                    placed(F.col("rest"), F.col("n_first")),
                )
            ),
        )
        .select("t", "id", *[F.when(one, F.col(c)).alias(c) for c in ("n", "place", "map")])
    )
    prefix = stored(prefix.dropDuplicates(["t", "id"]), "prefix")
    met = prefix.groupBy("t").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).filter("lo <> hi").select("t")
    return stored(prefix.join(met, "t", "left_semi"), "buckets")


def _possible(percent: int) -> Column:
    """Whether the bounds allow a link between (n, place, map) and (n_b, place_b, map_b)."""
    need = F.ceil(percent * (F.col("n") + F.col("n_b")) / (100 + percent))
    size = 100 * F.least("n", "n_b") >= percent * F.greatest("n", "n_b")
    place = (F.col("place") + need <= F.col("n")) & (F.col("place_b") + need <= F.col("n_b"))
    bits = [F.bit_count(F.col("map")[i].bitwiseXOR(F.col("map_b")[i])) for i in range(MAP_BITS // 64)]
    differ = sum(bits[1:], bits[0]) <= F.col("n") + F.col("n_b") - 2 * need
    return F.col("n").isNull() | F.col("n_b").isNull() | (size & place & differ)


def _verified(pairs: DataFrame, facts: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that link: prefixes under the other orders first, then the sets themselves."""

    def side(name: str) -> DataFrame:
        named = [F.col(c).alias(f"{name}_{c}") for c in ("n", "p2", "p3", "tokens")]
        return facts.select(F.col("id").alias(name), *named)

    both = F.size(F.array_intersect("a_tokens", "b_tokens"))
    return (
        pairs.join(side("a"), "a")
        .join(side("b"), "b")
        .filter(F.arrays_overlap("a_p2", "b_p2") & F.arrays_overlap("a_p3", "b_p3"))
        .filter(100 * both >= percent * (F.col("a_n") + F.col("b_n") - both))
        .select("a", "b")
        .distinct()
    )


def _merged(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """Labels (id, comp) after joining the components at both ends of every edge."""
    ends = edges.join(labels.select(F.col("id").alias("a"), F.col("comp").alias("x")), "a").join(
        labels.select(F.col("id").alias("b"), F.col("comp").alias("y")), "b"
    )
    joined = connected(ends.filter("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct())
    renamed = joined.select(F.col("id").alias("comp"), F.col("comp").alias("root"))
    return stored(
        labels.join(renamed, "comp", "left").select("id", F.coalesce("root", "comp").alias("comp")), "components"
    )


class _Facts:
    """Sets and prefixes of the documents that are compared: made from `plain` (id, text) once per id, when a pair needs them."""

    def __init__(self, plain: DataFrame, width: int, percent: int) -> None:
        self._plain, self._udf = plain, _prefix_udf(width, percent)
        self._made: DataFrame | None = None
        self._ids: DataFrame | None = None

    def of(self, pairs: DataFrame) -> DataFrame:
        """The facts of the ids of `pairs` (a, b)."""
        ids = stored(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "compared")
        new = ids if self._ids is None else stored(ids.join(self._ids, "id", "left_anti"), "new")
        if not new.isEmpty():
            made = stored(
                self._plain.join(small(new), "id", "left_semi")
                .select("id", self._udf("text").alias("f"))
                .select("id", "f.*")
                .dropDuplicates(["id", "s1", "s2"]),
                "facts",
            )
            self._made = made if self._made is None else self._made.union(made)
            self._ids = new if self._ids is None else self._ids.union(new)
        return self._made.join(small(ids), "id", "left_semi")


def _link(buckets: DataFrame, facts: _Facts, labels: DataFrame, percent: int) -> DataFrame:
    """Final labels of the documents that have candidates."""
    bounds = ("n", "place", "map")
    for turn in range(ROUNDS + 1):
        here = buckets.join(labels, "id")
        mixed_ = stored(
            here.groupBy("t")
            .agg(
                F.min("comp").alias("lo"),
                F.max("comp").alias("hi"),
                F.count("*").alias("size"),
                F.min_by(F.struct("id", "comp", *bounds), F.xxhash64("id", "t", F.lit(turn))).alias("pivot"),
            )
            .filter("lo <> hi"),
            "mixed",
        )
        open_pairs = mixed_.agg(F.sum(F.col("size") * (F.col("size") - 1) / 2)).first()[0] or 0
        if not open_pairs:
            return labels
        last = turn == ROUNDS or open_pairs <= FEW_PAIRS
        if last:
            rest = here.join(mixed_.select("t"), "t", "left_semi")
            other = rest.select("t", *[F.col(c).alias(f"{c}_b") for c in ("id", "comp", *bounds)])
            apart = F.col("comp") < F.col("comp_b")
        else:
            rest = here
            other = mixed_.select("t", *[F.col(f"pivot.{c}").alias(f"{c}_b") for c in ("id", "comp", *bounds)])
            apart = F.col("comp") != F.col("comp_b")
        found = rest.join(other, (rest["t"] == other["t"]) & apart & _possible(percent))
        pairs = found.select(F.least("id", "id_b").alias("a"), F.greatest("id", "id_b").alias("b")).distinct()
        pairs = stored(pairs, "pairs")
        if not pairs.isEmpty():
            edges = stored(_verified(pairs, facts.of(pairs), percent), "links")
            if not edges.isEmpty():
                labels = _merged(labels, edges)
        if last:
            return labels
    return labels


def jaccard_components(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """One row per row of `docs`: doc_id, n_shingles, component_id (the smallest doc_id that links reach)."""
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST))
    plain = docs.select(key.alias("id"), F.col("text"))
    base = stored(
        plain.select("id", _first_udf(width, percent)("text").alias("f")).select("id", "f.*"), "shingles"
    )
    full = base.filter("n > 0")
    classes = stored(
        full.groupBy("s1", "s2").agg(
            F.min("id").alias("id"), F.first("n").alias("n"), F.first("first").alias("first"), F.first("rest").alias("rest"), F.first("map").alias("map")
        ),
        "classes",
    )
    buckets = _buckets(classes, percent)
    light = full.select("id", "s1", "s2").distinct()
    leads = light.join(classes.select("s1", "s2", F.col("id").alias("lead")), ["s1", "s2"])
    several = (
        leads.groupBy("id").agg(F.min("lead").alias("a"), F.max("lead").alias("z")).filter("a <> z").select("id", "a")
    )
    extra = stored(
        leads.join(several, "id").filter("a <> lead").select("a", F.col("lead").alias("b")).distinct(), "repeated"
    )
    labels = stored(classes.select("id").distinct().withColumn("comp", F.col("id")), "components")
    if not extra.isEmpty():
        labels = _merged(labels, extra)
    labels = _link(buckets, _Facts(plain, width, percent), labels, percent)
    found = base.join(classes.select("s1", "s2", F.col("id").alias("lead")), ["s1", "s2"], "left").join(
        labels.select(F.col("id").alias("lead"), "comp"), "lead", "left"
    )
    component = F.coalesce("comp", "id")

    def named(value: Column) -> Column:
        return F.when(value != LAST, value)

    return found.select(
        named(F.col("id")).alias("doc_id"),
        F.col("n").alias("n_shingles"),
        named(component).alias("component_id"),
    )


def one_of_each(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """The rows of `docs` whose document is the smallest of its component."""
    found = jaccard_components(docs, width, percent).filter("doc_id <> component_id or (doc_id is null and component_id is not null)")
    gone = stored(found.select(F.coalesce("doc_id", F.lit(LAST)).alias("_gone")).distinct(), "gone")
    return docs.join(small(gone), F.coalesce(docs["doc_id"].cast("long"), F.lit(LAST)) == F.col("_gone"), "left_anti")
