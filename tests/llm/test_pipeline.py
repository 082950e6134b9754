import pytest

import corpus_pipeline
import __spark_entry__ as entry
from tests.llm.conftest import frame

MID = "/root/testdata/sf0.01"


def test_registered():
    names = [q for q in entry.queries() if q.startswith("op")]
    assert sorted(int(q[2:].split("_")[0]) for q in names) == list(range(1, 11))
    assert "pipeline" in entry.queries()
    assert [k for k, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "language id", "n-gram Jaccard join", "best-fit packing"]


def test_stages_keep_columns_and_thin_out(spark):
    docs = spark.read.parquet(f"{MID}/documents.parquet")
    labels = spark.read.parquet(f"{MID}/labels.parquet")
    good = {r["doc_id"] for r in labels.where("quality = 1").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r["doc_id"] for r in docs.select("doc_id").collect()}
        docs = stage(spark, docs, MID).cache()
        after = {r["doc_id"] for r in docs.select("doc_id").collect()}
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        assert after <= before
        if name != "n-gram Jaccard join":
            assert len(good & after) >= 0.98 * len(good & before)
        else:
            assert docs.select("text").distinct().count() == docs.count()
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, MID).collect()
    assert {r["doc_id"] for r in pieces} == after


@pytest.mark.parametrize("k", range(4))
def test_stages_on_strange_rows(k, spark, edge_docs, no_docs):
    stage = corpus_pipeline.STAGES[k][1]
    got = stage(spark, edge_docs, MID)
    if k < 3:
        assert got.columns == edge_docs.columns
    got.collect()
    assert stage(spark, no_docs, MID).collect() == []


def test_near_duplicates_keep_one(spark):
    text = " ".join(f"w{i}" for i in range(50))
    docs = frame(spark, [(4, text, "en"), (2, text + " more", "en"), (2, text + " more", "en"), (9, "other words", "en"),
                         (None, text, "en"), (5, None, "en"), (6, "", "en")])
    kept = corpus_pipeline.near_duplicates(spark, docs, MID).collect()
    assert sorted(r["doc_id"] for r in kept) == [2, 5, 6, 9]


def test_rows_of_keeps_columns_named_like_its_own(spark):
    from pulsekit.llm.common import rows_of
    docs = spark.createDataFrame([(1, "a", "mine", 5), (None, None, "yours", 6)],
                                 "doc_id long, text string, __llm_id string, __llm_text long")
    kept = spark.sql("SELECT 1L AS doc_id, xxhash64('a') AS text_key UNION ALL SELECT NULL, xxhash64('')")
    assert sorted(map(tuple, rows_of(docs, kept, once=True).collect()), key=str) == [
        (1, "a", "mine", 5), (None, None, "yours", 6)]
