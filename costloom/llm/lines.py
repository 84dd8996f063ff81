"""Line dedup by a deletion-neighbourhood join over words.

Two lines are near when one word changed, inserted or removed turns one into the other and the longer
has at least five words (similarity 0.8 or more). The bound doesn't grow with the line: at forty words it is a
similarity of 0.975, and a line with two edits (0.95) is kept as new. Lines are compared without blanks at their ends;
words are what stands between single blanks. The order of lines is (doc_id, place in the text). A line
goes when the same line, or a near one, stands earlier anywhere in the corpus, whether that earlier one
stays or not; so the result depends neither on partitions nor on the order of work.

Plan, all of it DataFrame operations:

1. Exact copies: minimum id per 128-bit line hash, combined before the shuffle.
2. One edit leaves one half of a line untouched, so near lines share a half. Half hashes that occur in
   two different lines select the few lines whose neighbourhood is worth emitting; none is lost.
3. Neighbourhood: for every word position the hash of the line with that word blanked (changed words) or
   removed (inserted words). Line hashes are XORs of hashes of (word, position), so a variant costs one
   XOR. Variants are numbers; the lines of one key all are neighbours of each other, or of the whole line
   with that key, so the minimum per key replaces pairs within it.
4. The earliest neighbour of a key is compared with each line word by word before the line goes.

Null texts count as empty, empty lines are never copies and always stay, null ids come last in the order;
rows that share an id are equally early, so neither removes lines of the other. Repeated rows both stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costloom.llm.storage import fresh, let, small, stored

LAST = 2**63 - 1
MIN_WORDS = 5
BLOCK = 64


def _trimmed(text: Column) -> Column:
    return F.transform(F.split(F.coalesce(text, F.lit("")), "\n", -1), lambda x: F.trim(x))


def _n_words(line: Column) -> Column:
    return F.length(line) - F.length(F.replace(line, F.lit(" "), F.lit(""))) + 1


def _lines(docs: DataFrame) -> DataFrame:
    """The different lines of each row: id, pos, line."""
    return (
        docs.select(
            F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("id"),
            F.posexplode(F.array_distinct(_trimmed(F.col("text")))).alias("pos", "line"),
        )
        .filter("line <> ''")
    )


def _half_keys(line: Column, n: Column) -> Column:
    """Hashes of the halves of a line. Lines one word apart share one of them.

    With n words the edit is behind the first n/2 words or before the rest; the third key is the half
    that a line with one word less has.
    """
    half = F.floor(n / 2).cast("int")

    def first(m: Column) -> Column:
        return F.xxhash64(F.lit("P"), m, F.call_function("substring_index", line, F.lit(" "), m))

    def last(m: Column) -> Column:
        return F.xxhash64(F.lit("S"), m, F.call_function("substring_index", line, F.lit(" "), -m))

    return F.array(first(half), last(n - half), F.when(n % 2 == 1, last(half)).otherwise(first(half - 1)))


def _xor(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda a, x: a.bitwiseXOR(x))


def _variants(words: Column, n: Column) -> Column:
    """(kind, slot, key) of a line's neighbourhood.

    Kind 0: a word blanked; kind 1: the whole line, as what a longer line becomes; kind 2: a word removed.
    Removing word i moves the words behind it, so their hashes change; suffix XORs of the changes are
    taken over blocks, which keeps the work near linear in the length.
    """
    slots = F.sequence(F.lit(0), n - 1)

    def build(here: Column, moved: Column, total: Column) -> Column:
        def with_blocks(blocks: Column) -> Column:
            def behind(i: Column) -> Column:
                rest = F.slice(moved, i + 2, F.lit(BLOCK - 1) - i.bitwiseAND(F.lit(BLOCK - 1)))
                return _xor(rest).bitwiseXOR(
                    _xor(F.slice(blocks, F.shiftright(i, 6) + 2, F.size(blocks)))
                )

            def at(i: Column) -> Column:
                without = total.bitwiseXOR(F.element_at(here, i + 1))
                return F.array(
                    F.struct(F.lit(0).alias("kind"), i.alias("slot"), F.xxhash64(F.lit(0), n, i, without).alias("key")),
                    F.struct(
                        F.lit(2).alias("kind"),
                        i.alias("slot"),
                        F.xxhash64(F.lit(1), n - 1, without.bitwiseXOR(behind(i))).alias("key"),
                    ),
                )

            whole = F.array(
                F.struct(F.lit(1).alias("kind"), F.lit(-1).alias("slot"), F.xxhash64(F.lit(1), n, total).alias("key"))
            )
            return F.concat(whole, F.flatten(F.transform(slots, at)))

        starts = F.sequence(F.lit(0), F.shiftright(n - 1, 6))
        return let(
            F.transform(starts, lambda k: _xor(F.slice(moved, k * BLOCK + 1, F.lit(BLOCK)))), with_blocks
        )

    here = F.transform(words, lambda w, i: F.xxhash64(w, i))
    moved = F.transform(words, lambda w, i: F.xxhash64(w, i).bitwiseXOR(F.xxhash64(w, i - 1)))
    return let(
        F.struct(here.alias("here"), moved.alias("moved")),
        lambda h: let(_xor(h["here"]), lambda total: build(h["here"], h["moved"], total)),
    )


def _one_edit_apart(a: Column, b: Column) -> Column:
    """Whether at most one changed, inserted or removed word separates two word arrays."""

    def check(same: Column) -> Column:
        rest_a, rest_b = F.slice(a, same + 1, F.size(a)), F.slice(b, same + 1, F.size(b))
        tail_a, tail_b = F.slice(a, same + 2, F.size(a)), F.slice(b, same + 2, F.size(b))
        return (
            F.when(F.size(a) == F.size(b), tail_a == tail_b)
            .when(F.size(a) == F.size(b) + 1, tail_a == rest_b)
            .when(F.size(a) + 1 == F.size(b), rest_a == tail_b)
            .otherwise(False)
        )

    differs = F.transform(F.arrays_zip(a.alias("a"), b.alias("b")), lambda x: x["a"].eqNullSafe(x["b"]))
    place = F.array_position(differs, False)
    return let(F.when(place == 0, F.least(F.size(a), F.size(b))).otherwise(place - 1).cast("int"), check)


def near_lines(lines: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """`h1, h2` of the lines that have an earlier near line. `lines` holds (id, pos, line)."""
    n = _n_words(F.col("line"))
    long = lines.filter(n >= min_words - 1).withColumn("n", n)
    # Read twice each, so both kinds of keys are stored: they are numbers, and made anew they cost the most.
    keys = stored(
        long.select(F.xxhash64("line").alias("h1"), F.explode(_half_keys(F.col("line"), F.col("n"))).alias("half")),
        "keys",
    )
    met = stored(
        keys.groupBy("half").agg(F.min("h1").alias("lo"), F.max("h1").alias("hi")).filter("lo <> hi").select("half"),
        "halves",
    )
    chosen = stored(keys.join(small(met), "half", "left_semi").select("h1").distinct(), "chosen")
    lines_of = long.withColumn("h1", F.xxhash64("line")).join(small(chosen), "h1", "left_semi")
    first = stored(
        lines_of.groupBy("h1", F.xxhash64(F.lit(1), "line").alias("h2")).agg(
            F.min(F.struct("id", "pos")).alias("at"), F.first("line").alias("line")
        ).select("h1", "h2", F.struct("at.id", "at.pos", "h1", "h2").alias("at"), F.split("line", " ", -1).alias("words")),
        "candidates",
    )
    own = stored(
        first.select("h1", "h2", "at", F.inline(_variants(F.col("words"), F.size("words"))), F.size("words").alias("n"))
        .filter((F.col("kind") == 1) | (F.col("n") >= min_words))
        .drop("slot", "n"),
        "neighbours",
    )
    shared = stored(
        own.groupBy("key").agg(F.min("h1").alias("lo"), F.max("h1").alias("hi")).filter("lo <> hi").select("key"),
        "variants",
    )
    members = stored(own.join(small(shared), "key", "left_semi"), "members")
    leads = members.groupBy("key").agg(
        F.min(F.when(F.col("kind") != 2, F.col("at"))).alias("plain"),
        F.min(F.when(F.col("kind") == 2, F.col("at"))).alias("shortened"),
    )
    pairs = (
        members.join(leads, "key")
        .withColumn("lead", F.when(F.col("kind") == 1, F.col("shortened")).otherwise(F.col("plain")))
        .filter("lead < at")
        .select("h1", "h2", F.col("lead.h1").alias("l1"), F.col("lead.h2").alias("l2"))
        .distinct()
    )
    texts = first.select("h1", "h2", "words")
    leaders = first.select(F.col("h1").alias("l1"), F.col("h2").alias("l2"), F.col("words").alias("lead_words"))
    return (
        pairs.join(texts, ["h1", "h2"])
        .join(leaders, ["l1", "l2"])
        .filter(_one_edit_apart(F.col("words"), F.col("lead_words")))
        .select("h1", "h2")
        .distinct()
    )


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """`docs` with their text cut to the lines that stay, and four counts.

    Adds n_lines (lines that are not empty), n_exact and n_near (lines removed as copies and as near
    copies; an exact copy counts as exact) and n_kept. Other columns are untouched; a column of `docs`
    that has the name of a count keeps its place and is not overwritten: the count gets a leading `_`.
    """
    lines = _lines(docs)
    seen = lines.select("id", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2"))
    firsts = seen.groupBy("h1", "h2").agg(F.min("id").alias("first_id"))
    near = stored(near_lines(lines, min_words), "near").withColumn("near", F.lit(True))
    verdicts = firsts.join(near, ["h1", "h2"], "left")
    drops = (
        seen.join(verdicts, ["h1", "h2"])
        .filter("first_id < id or near")
        .groupBy("id")
        .agg(
            F.collect_set(F.when(F.col("first_id") < F.col("id"), F.col("h1"))).alias("copies"),
            F.collect_set(F.when(~(F.col("first_id") < F.col("id")), F.col("h1"))).alias("nears"),
        )
    )
    row = fresh(docs, "_drops")
    key = F.coalesce(docs["doc_id"].cast("long"), F.lit(LAST))
    joined = docs.join(
        drops.select(F.col("id").alias(f"{row}_id"), F.struct("copies", "nears").alias(row)),
        key == F.col(f"{row}_id"),
        "left",
    )
    none = F.array().cast("array<bigint>")

    def judged(ls: Column) -> Column:
        copies, nears = F.coalesce(F.col(row)["copies"], none), F.coalesce(F.col(row)["nears"], none)
        return F.transform(
            ls,
            lambda x, i: F.struct(
                x.alias("line"),
                F.when(F.trim(x) == "", 0)
                .when(F.array_contains(copies, F.xxhash64(F.trim(x))), 1)
                .when(F.array_position(F.transform(ls, lambda y: F.trim(y)), F.trim(x)) <= i, 1)
                .when(F.array_contains(nears, F.xxhash64(F.trim(x))), 2)
                .otherwise(3)
                .alias("fate"),
            ),
        )

    fate = let(F.split(F.coalesce(docs["text"], F.lit("")), "\n", -1), judged)
    full = joined.withColumn(row, fate)

    def count(*which: int) -> Column:
        return F.size(F.filter(F.col(row), lambda x: x["fate"].isin(*which))).cast("long")

    kept = F.array_join(
        F.transform(F.filter(F.col(row), lambda x: x["fate"].isin(0, 3)), lambda x: x["line"]), "\n"
    )
    names = [fresh(docs, n) for n in ("n_lines", "n_exact", "n_near", "n_kept")]
    counts = [count(1, 2, 3), count(1), count(2), count(3)]
    own = [kept.alias("text") if c == "text" else full["`" + c.replace("`", "``") + "`"] for c in docs.columns]
    return full.select(*own, *[c.alias(n) for c, n in zip(counts, names, strict=True)])
