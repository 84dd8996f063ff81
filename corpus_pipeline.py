"""The corpus pipeline: documents go through five stages; each is written and read again before the next.

Every function takes (spark, docs, sf_dir). All but the last return the columns of `documents`. Documents are long
rows, so the pipeline sends fewer of them to Python at once than Spark does by default (BATCH_ROWS; a lower setting of
the session stays): the stages' Python workers and Arrow buffers share the executors' memory.

Null and empty texts, and null languages or sources, are rows like others: the rules reject documents without
words, and later stages keep what they get. Rows that share an id are judged as the stages' operators say; extra
columns are no input of any stage and are carried along.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from costloom.llm import decontam, jaccard, lines, pieces, rules
from costloom.llm.storage import columns, stored, table

BATCH_ROWS = 1000


def _small_batches(spark: SparkSession) -> None:
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    _small_batches(spark)
    return rules.keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Copied lines go, and documents that had text and have no line left."""
    done = lines.dedup_lines(docs)
    counts = done.columns[len(docs.columns) :]
    n_lines, n_kept = done[counts[0]], done[counts[3]]
    return done.filter((n_kept > 0) | (n_lines == 0)).select(*columns(done)[: len(docs.columns)])


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones stays, the one with the smallest id.

    Similar are word shingles of five with a Jaccard index of 0.8; the query op10 has bounds of its own.
    """
    _small_batches(spark)
    return jaccard.one_of_each(docs, width=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    _small_batches(spark)
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts become ids of sampled pieces."""
    _small_batches(spark)
    return pieces.encode_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("jaccard_join", jaccard_join),
    ("decontamination", decontamination),
    ("sentencepiece", sentencepiece),
]

#: The stages sample segmentations and sketch quantiles; tests compare them with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of `sf_dir`."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
