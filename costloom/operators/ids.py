"""Dense ids in a global order, without sorting everything in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from costloom.functions.missing import col
from costloom.session import ensure_checkpoint_dir

_POSITION_BITS = 33


def dense_ids(df: DataFrame, order: list[str], out: str) -> DataFrame:
    """Number rows 0, 1, 2, ... in the given order.

    Rows are split by range and sorted inside their partition; a hash of the whole row comes
    last, so that many rows with one order key still spread over partitions. The result is checkpointed, so
    that a lost executor cannot lead to other range bounds; then each partition's offset, a
    running sum over at most one row per partition, is added to the position inside it.
    """
    ensure_checkpoint_dir(df.sparkSession)
    by = [*order, "_tie"]
    hashed = df.withColumn("_tie", F.xxhash64(*[col(c) for c in df.columns]))
    ranged = hashed.repartitionByRange(*by).sortWithinPartitions(*by).drop("_tie")
    placed = ranged.withColumn("_place", F.monotonically_increasing_id()).checkpoint()
    part = F.shiftright(F.col("_place"), _POSITION_BITS)
    placed = placed.withColumns(
        {"_part": part, "_at": F.col("_place") - F.shiftleft(part, _POSITION_BITS)}
    )
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select(
        F.col("_part").alias("_p"),
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"),
    )
    numbered = placed.join(offsets, F.col("_part") == F.col("_p"))
    return numbered.withColumn(out, F.col("_offset") + F.col("_at")).drop(
        "_place", "_part", "_at", "_p", "_offset"
    )
