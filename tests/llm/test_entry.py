"""The registered queries and the pipeline on the smallest test tables."""

from __future__ import annotations

import os
import random

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from costloom.llm.queries import QUERIES
from costloom.llm.storage import stored
from tests.llm.test_operators import DOCS, one_edit, prose

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


def test_names():
    assert {*QUERIES, "pipeline"} <= set(entry.queries())
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "line_dedup", "jaccard_join", "decontamination", "sentencepiece"
    ]


def test_line_dedup_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{FOLDER}/documents.parquet'")
    want = con.execute(entry.oracle_sql()["op1_line_dedup"]).fetchdf().sort_values("doc_id").reset_index(drop=True)
    got = entry.queries()["op1_line_dedup"](spark, FOLDER).toPandas().sort_values("doc_id").reset_index(drop=True)
    assert sorted(want.columns) == sorted(got.columns)
    assert (want[got.columns] == got).all().all()


def test_pipeline_keeps_columns_and_clean_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    now = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = stored(stage(spark, now, FOLDER), name)
        assert now.columns == docs.columns
    out = corpus_pipeline.STAGES[-1][1](spark, now, FOLDER)
    assert out.filter("not lossless").count() == 0
    assert 0.6 * docs.count() < out.count() < docs.count()


def brute_pipeline(rows, item):
    """Ids that stay, by comparing everything with everything."""
    rows = [(i, t) for i, t in rows if len(t.split()) >= 50]
    seen, kept = [], []
    for i, text in rows:
        lines = []
        for line in text.split("\n"):
            words = line.split()
            if not any(words == x or one_edit(words, x) for x in seen):
                lines.append(line)
            seen.append(words)
        if lines:
            kept.append((i, "\n".join(lines)))
    sets = [{tuple(w[k : k + 5]) for k in range(len(w) - 4)} for w in (t.split() for _, t in kept)]
    group = list(range(len(kept)))
    for a in range(len(kept)):
        for b in range(a):
            if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                group = [group[b] if g == group[a] else g for g in group]
    ids = [min(i for (i, _), g in zip(kept, group, strict=True) if g == own) for own in group]
    return sorted(i for (i, t), least in zip(kept, ids, strict=True) if i == least and item not in t.replace("\n", " "))


def test_pipeline_matches_brute_force(spark, tmp_path):
    rng = random.Random(3)
    item = "How many crates does a porter carry from the old pier to the new hall when each cart holds nine?"
    rows = []
    for k in range(8):
        lines = [prose(100 + 10 * k + n, 100).split() for n in range(5)]
        rows.append((len(rows) + 1, lines))
        # Two, four and eight changed words in each line: 0.82, 0.67 and 0.43 on shingles of five.
        for changes in (2, 4, 8):
            copy = [list(x) for x in lines]
            for line in copy:
                for place in rng.sample(range(5, 95), changes):
                    line[place] = f"changed{rng.randrange(10**9)}"
            rows.append((len(rows) + 1, copy))
    rows = [(i, "\n".join(" ".join(x) for x in lines)) for i, lines in rows]
    rows += [(101, "too short"), (102, rows[0][1]), (103, f"{prose(7, 100)}\n{item}\n{prose(8, 100)}")]
    frame = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], DOCS)
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = sorted(r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).select("doc_id").collect())
    want = brute_pipeline(rows, item)
    assert got == want
    assert len(want) < 3 * 8 + 1
