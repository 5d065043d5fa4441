"""The stages of the corpus pipeline against plain versions, and its SQL queries."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from check_oracle import compare, duck
from tests.conftest import SMALL
from tests.llm.common import clashing, docs_of, shingles
from tests.llm.test_texts import base_spans
from tripmart.llm.oracle import ORACLE
from tripmart.llm.shared import table


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_oracle(spark, name):
    assert compare(spark, duck(SMALL), SMALL, name) == ""


def test_stages_decide_on_all_documents(spark):
    docs = table(spark, SMALL, "documents").cache()
    before = {r["doc_id"]: r["text"] for r in docs.collect()}
    toxic, copies, leaks, secret, encode = (f for _, f in corpus_pipeline.STAGES)

    kept = {r["doc_id"] for r in copies(spark, docs, SMALL).collect()}
    sets = {i: shingles(t) for i, t in before.items()}
    # Every dropped document has a kept or dropped neighbour, no two kept ones are near.
    near = lambda a, b: 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]) > 0
    assert all(any(near(i, j) for j in before if j < i) for i in before if i not in kept)
    assert not any(near(a, b) for a in kept for b in kept if a < b)

    items = [r["text"] for r in table(spark, SMALL, "benchmark").collect()]
    clean = {r["doc_id"] for r in leaks(spark, docs, SMALL).collect()}
    assert not any(item in before[i] for i in clean for item in items)

    for row in secret(spark, docs, SMALL).collect():
        assert not base_spans(row["text"]) and row["n_chars"] == len(row["text"])
        assert base_spans(before[row["doc_id"]]) or row["text"] == before[row["doc_id"]]

    for stage in (toxic, copies, leaks, secret):
        assert stage(spark, docs, SMALL).columns == docs.columns
    assert encode(spark, docs, SMALL).where("exact").count() == len(before)
    docs.unpersist()


def test_awkward_and_empty_documents(spark):
    rows = [None, "", (None, "a text of more than five words here"), "same text of five words", "same text of five words", (3, "same text of five words")]
    for frame in (docs_of(spark, []), clashing(docs_of(spark, rows)).withColumn("extra", F.lit(1))):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, frame, SMALL)
            assert out.columns == frame.columns
            out.collect()
        corpus_pipeline.STAGES[-1][1](spark, frame, SMALL).collect()


def test_run_is_all_stages(spark):
    rows = corpus_pipeline.run(spark, SMALL).collect()
    assert 0 < len(rows) < 200 and all(r["exact"] for r in rows)
