"""Joins whose shape matters at scale. Plain equi-joins are left to `DataFrame.join`.

No join here carries a broadcast hint: Spark broadcasts a side only when its estimated or
measured size is below `spark.sql.autoBroadcastJoinThreshold`, and otherwise sorts and merges,
splitting skewed partitions at run time.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costloom.functions.missing import col
from costloom.operators.watch import counted


def left_lookup(
    df: DataFrame,
    dim: DataFrame,
    left_key: str,
    right_key: str,
    take: dict[str, str] | list[str],
    lookup: str = "",
) -> DataFrame:
    """Left join one key, adding only the named columns (a dict renames them).

    Several dimension rows for one key give several result rows, as a merge does. A `LookupWatch` reports that,
    under the name `lookup`; `duplicate_keys` finds the keys of one table.
    """
    names = take if isinstance(take, dict) else {n: n for n in take}
    slim = dim.select(col(right_key).alias("_key"), *[col(a).alias(b) for a, b in names.items()])
    return counted(
        f"{lookup or 'lookup'}: {left_key}", df, slim, ["_key"],
        lambda rows: rows.join(slim, col(left_key) == F.col("_key"), "left").drop("_key"),
    )


def left_on(df: DataFrame, other: DataFrame, keys: list[str], take: list[str]) -> DataFrame:
    """Left join on equally named keys, adding the named columns."""
    return df.join(other.select(*keys, *[col(n) for n in take]), keys, "left")


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their row count (empty for a clean dimension)."""
    return df.groupBy(*keys).count().filter(F.col("count") > 1)


def keyed(df: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with all keys, and rows that miss one."""
    whole = reduce(lambda a, b: a & b, [col(k).isNotNull() for k in keys])
    return df.filter(whole), df.filter(~whole)


def missing_keys(feeds: dict[str, DataFrame], keys: list[str]) -> DataFrame:
    """(feed, n): rows of each feed that miss a key; one row per feed, also without any."""
    counts = [
        keyed(df, keys)[1].agg(F.lit(name).alias("feed"), F.count(F.lit(1)).alias("n")) for name, df in feeds.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def align_apart(feeds: list[DataFrame], keys: list[str], unique: bool = False) -> DataFrame:
    """`align` where rows that miss a key match nothing: each stays, once, with the other feeds' columns missing.

    Missing keys that match each other multiply: n such rows in each of six feeds would give n^6. Nothing says that
    they belong together, so here they give 6 n. `unique` says that no feed repeats a whole key.
    """
    parts = [keyed(f, keys) for f in feeds]
    whole = (align_unique if unique else align)([p[0] for p in parts], keys)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [whole, *[p[1] for p in parts]])


def align(feeds: list[DataFrame], keys: list[str]) -> DataFrame:
    """Full outer join of several feeds on shared keys, missing keys matching each other, as in a merge.

    Where many rows may miss a key use `align_apart`.

    The distinct keys of all feeds come first; each feed is then left-joined to them. A left
    join keeps the partitioning of its left side, so every feed is shuffled once and the
    growing result never again. A chain of full outer joins would reshuffle it at every step,
    and could not split a skewed key.
    """
    universe = reduce(DataFrame.unionByName, [f.select(*keys) for f in feeds]).distinct()
    for feed in feeds:
        right = feed.withColumnsRenamed({k: f"_r_{k}" for k in keys})
        same = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
        universe = universe.join(right, reduce(lambda a, b: a & b, same), "left").drop(
            *[f"_r_{k}" for k in keys]
        )
    return universe


def align_unique(feeds: list[DataFrame], keys: list[str]) -> DataFrame:
    """`align` for feeds that hold at most one row per key: one shuffle in all.

    The feeds are stacked and grouped, so rows combine before the shuffle. A feed with two rows
    for one key stops the job with an error instead of losing one of them.
    """
    tagged = []
    for i, feed in enumerate(feeds):
        tagged.append(feed.withColumn(f"_n{i}", F.lit(1)))
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
    out: list[Column] = []
    for i, feed in enumerate(feeds):
        for name in feed.columns:
            if name not in keys:
                out.append(F.max(col(name)).alias(name))
        out.append(F.sum(f"_n{i}").alias(f"_n{i}"))
    counts = [f"_n{i}" for i in range(len(feeds))]
    twice = reduce(lambda a, b: a | b, [F.coalesce(F.col(c), F.lit(0)) > 1 for c in counts])
    grouped = stacked.groupBy(*keys).agg(*out)
    checked = F.when(twice, F.raise_error(F.lit("a feed repeats a key"))).otherwise(col(keys[0]))
    return grouped.withColumn(keys[0], checked).drop(*counts)


def hot_keys(df: DataFrame, keys: list[str], partitions: int) -> DataFrame:
    """(_hot, _copies): hashes of the keys with more rows than an average partition, and how far to spread them.

    Found by a frequent-items sketch, which tasks merge and whose size the partition count bounds: fewer keys than
    partitions can be hot, and a key it names has at least the rows that it says. Four copies per average partition.
    """
    tracked = max(1024, 8 * partitions)
    top = F.expr(f"approx_top_k(h, {min(partitions, tracked)}, {tracked})")
    sketch = df.select(_key_hash(keys).alias("h")).agg(top.alias("top"), F.count(F.lit(1)).alias("n"))
    share = F.col("count") * F.lit(float(partitions)) / F.col("n")
    found = sketch.select("n", F.inline("top")).filter(share > 1)
    return found.select(F.col("item").alias("_hot"), F.ceil(4 * share).cast("int").alias("_copies"))


def _key_hash(keys: list[str]) -> Column:
    return F.xxhash64(*[col(k) for k in keys])


def densify(entities: DataFrame, items: DataFrame, partitions: int | None = None) -> DataFrame:
    """Natural full outer join: every entity gets every item that shares its common columns.

    The common column is often one value for nearly all rows (a business group), and a plain shuffle join would
    send these to one task. So the entities of such hot keys are spread over salts, and only the items of these
    keys are copied, once per salt; all other keys join as they are. Hot is a key with more rows than an average one
    of `partitions` (by default the shuffle's number). Items without an entity are added at the end.
    Without common columns there is no key to join on, which is an error.
    """
    common = [c for c in entities.columns if c in items.columns]
    if not common:
        raise ValueError("entities and items share no column")
    partitions = partitions or int(entities.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = F.broadcast(hot_keys(entities, common, partitions))  # fewer rows than partitions

    def with_copies(df: DataFrame) -> DataFrame:
        joined = df.withColumn("_h", _key_hash(common)).join(hot, F.col("_h") == F.col("_hot"), "left")
        return joined.withColumn("_copies", F.coalesce("_copies", F.lit(1))).drop("_h", "_hot")

    spread = F.xxhash64(*[col(c) for c in entities.columns])
    salted = with_copies(entities).withColumn("_salt", F.pmod(spread, F.col("_copies"))).drop("_copies")
    copies = with_copies(items).withColumn("_r_salt", F.explode(F.sequence(F.lit(0), F.col("_copies") - 1)))
    copies = copies.drop("_copies").withColumnsRenamed({c: f"_r_{c}" for c in common})
    cond = reduce(
        lambda a, b: a & b,
        [F.col("_salt") == F.col("_r_salt")]
        + [col(c).eqNullSafe(col(f"_r_{c}")) for c in common],
    )
    drop = ["_salt", "_r_salt"] + [f"_r_{c}" for c in common]
    matched = salted.join(copies, cond, "left").drop(*drop)
    present = entities.select(*[col(c).alias(f"_r_{c}") for c in common]).distinct()
    absent_cond = reduce(
        lambda a, b: a & b, [col(c).eqNullSafe(col(f"_r_{c}")) for c in common]
    )
    orphans = items.join(present, absent_cond, "left_anti")
    return matched.unionByName(orphans, allowMissingColumns=True)


def without_pairs(df: DataFrame, left: str, right: str, pairs: list[tuple[str, str]]) -> DataFrame:
    """Remove rows that hold one of the (left, right) value pairs."""
    hit = reduce(lambda a, b: a | b, [(col(left) == x) & (col(right) == y) for x, y in pairs])
    return df.filter(~F.coalesce(hit, F.lit(False)))


def rows_matching(df: DataFrame, wanted: dict[str, object]) -> DataFrame:
    """Rows equal to every given key value."""
    for name, value in wanted.items():
        df = df.filter(col(name) == F.lit(value))
    return df
