"""Choosing labelled documents to learn from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(doc_id: Column) -> Column:
    """Documents that no model learns from: crc32 of the id as text is a multiple of five."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int, longest: int) -> DataFrame:
    """(text, label) of at most `per_class` documents per class, at most `longest` characters each.

    The documents are those with the smallest hashes of their ids, so the sample is the same in any run; its size
    doesn't grow with the corpus. Held-out documents, null ids and null labels are left out.
    """
    known = labels.select("doc_id", F.col(label).cast("int").alias("label")).filter(
        F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("doc_id"))
    )
    short = docs.filter(F.length("text") <= longest).select(F.col("doc_id").alias("id"))
    open_ = known.join(short.distinct(), F.col("doc_id") == F.col("id"), "left_semi")
    order = F.xxhash64("doc_id", F.lit(label))
    chosen = None
    for value in (0, 1):
        part = open_.filter(F.col("label") == value).distinct().orderBy(order, "doc_id").limit(per_class)
        chosen = part if chosen is None else chosen.union(part)
    chosen = F.broadcast(chosen.select(F.col("doc_id").alias("id"), "label"))
    return (
        docs.filter(F.length("text") <= longest)
        .join(chosen, F.col("doc_id") == F.col("id"))
        .select("doc_id", "text", "label")
        .orderBy(order, "doc_id", "text", "label")
        .limit(2 * per_class)
    )
