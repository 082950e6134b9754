"""Operators 1, 2 and 5: a direct model, and held-out accuracy."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsekit.llm import byte_cnn_lang, gbt_toxicity, kn_quality
from pulsekit.llm.common import job_dir
from tests.llm.conftest import frame

MID = "/root/testdata/sf0.01"


def direct_kneser_ney(texts, order):
    """log probability of a byte after a context, from plain dictionaries."""
    counts = {order: {}}
    for t in texts:
        x = b"\0" * (order - 1) + t
        for i in range(len(t)):
            g = x[i:i + order]
            counts[order][g] = counts[order].get(g, 0) + 1
    for k in range(order - 1, 0, -1):
        counts[k] = {}
        for g in counts[k + 1]:
            counts[k][g[1:]] = counts[k].get(g[1:], 0) + 1
    discount = {}
    for k, c in counts.items():
        n = [sum(v == i for v in c.values()) for i in range(5)]
        y = n[1] / (n[1] + 2 * n[2]) if n[1] and n[2] else 0.5
        discount[k] = [0] + [min(max(i - (i + 1) * y * n[i + 1] / n[i], 0.05), i - 0.05) if n[i] and n[i + 1] else 0.5 * i
                             for i in (1, 2, 3)]

    def p(g):
        if not g:
            return 1 / 256
        k = len(g)
        same = {w: c for w, c in counts[k].items() if w[:-1] == g[:-1]}
        if not same:
            return p(g[1:])
        total = sum(same.values())
        off = {w: discount[k][min(c, 3)] for w, c in same.items()}
        own = (same[g] - off[g]) / total if g in same else 0.0
        return own + sum(off.values()) / total * p(g[1:])

    return lambda text: math.exp(-sum(math.log(p((b"\0" * (order - 1) + text)[i:i + order]))
                                      for i in range(len(text))) / len(text))


@pytest.mark.parametrize("order", [2, 4])
def test_perplexity_is_the_direct_models(spark, order):
    texts = ["abracadabra", "the cat sat on the mat", "the dog sat", "été à la plage", "aaaa", "abab the end", "mat cat"]
    others = ["the cat", "zzz", "été", "q", "abracadabra the dog on the mat"]
    folder = job_dir(spark, "test-kn")
    model = kn_quality.Model(kn_quality.count_ngrams(spark.createDataFrame([(t,) for t in texts], "text string"), order), order, folder)
    docs = spark.createDataFrame([(t, i) for i, t in enumerate([*texts, *others, ""])], "text string, i int")
    got = {r["i"]: r["perplexity"] for r in kn_quality.perplexities(docs, model, folder, block_bytes=20).collect()}
    want = direct_kneser_ney([t.encode() for t in texts], order)
    for i, t in enumerate([*texts, *others]):
        assert got[i] == pytest.approx(want(t.encode()), rel=1e-5)
    assert got[len(texts) + len(others)] is None


def test_probabilities_sum_to_one(spark):
    texts = ["abracadabra", "the cat sat on the mat", "the dog sat"]
    ngrams = kn_quality.count_ngrams(spark.createDataFrame([(t,) for t in texts], "text string"), 3)
    model = kn_quality.Model(ngrams, 3, job_dir(spark, "test-kn"))
    for h in (b"th", b"zz", b"xa"):
        base = int.from_bytes(h, "big") << 8
        asked = spark.createDataFrame([(base + b,) for b in range(256)], "g long")
        assert sum(math.exp(r["lp"]) for r in model.log_probabilities(asked).collect()) == pytest.approx(1.0, rel=1e-9)


def test_op1_edges(spark, edge_docs, no_docs):
    ids = spark.createDataFrame([(5,), (3,), (9,), (None,), (99,)], "doc_id long")
    got = kn_quality.quality(edge_docs, ids, order=3).collect()
    assert len(got) == edge_docs.count()
    assert all(not r["keep"] and r["perplexity"] is None for r in got if r["doc_id"] in (7, 8))
    assert kn_quality.quality(no_docs, ids, order=3).collect() == []
    none = kn_quality.quality(edge_docs, ids.where("false"), order=3).collect()
    assert [r["keep"] for r in none] == [r["perplexity"] is not None for r in none]


def test_op1_keeps_good_and_rejects_junk(spark):
    docs, labels = (spark.read.parquet(f"{MID}/{t}.parquet") for t in ("documents", "labels"))
    got = kn_quality.quality(docs, labels.where("quality = 1").select("doc_id")).join(labels, "doc_id").toPandas()
    assert got[got.quality == 1].keep.mean() > 0.99
    assert got[got.quality == 0].keep.mean() < 0.3


def kind_of_junk(text):
    words = text.split()
    if any(words[i:i + 1] * 5 == words[i:i + 5] for i in range(len(words) - 4)):
        return "repeated"
    if sum(text.count(x) for x in ("***", "$$$", "%%%", "&&&")) > 3:
        return "symbols"
    if text.count(" | ") > 3:
        return "table"
    return "caps" if sum(w.isupper() for w in words) > 0.4 * len(words) else "other"


def test_op1_rejects_each_kind_of_junk(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    got = (kn_quality.quality(docs, labels.where("quality = 1").select("doc_id")).join(labels, "doc_id")
           .join(docs.select("doc_id", "text").distinct(), "doc_id").toPandas())
    assert got[got.quality == 1].keep.mean() > 0.99
    junk = got[got.quality == 0]
    kept = junk.groupby(junk.text.fillna("").map(kind_of_junk)).keep.mean()
    assert all(kept[k] < 0.02 for k in ("caps", "symbols", "table"))
    assert kept["repeated"] < 0.2


def test_op2(spark, edge_docs, no_docs):
    docs = spark.read.parquet(f"{MID}/documents.parquet")
    model = byte_cnn_lang.train(docs, ~byte_cnn_lang.held_out())
    got = (byte_cnn_lang.predict(docs, model).join(docs.select("doc_id", "lang"), "doc_id")
           .where(byte_cnn_lang.held_out()).toPandas())
    assert (got.lang == got.lang_pred).mean() > 0.97
    edge = {r["doc_id"]: r for r in byte_cnn_lang.predict(edge_docs, model).collect()}
    assert all(edge[i]["lang_pred"] == "und" and edge[i]["score"] == 0 for i in (7, 8, 13))
    assert edge[9]["lang_pred"] != "und" and 0 <= edge[9]["score"] <= 1
    assert byte_cnn_lang.predict(no_docs, model).collect() == []
    carried = byte_cnn_lang.predict(edge_docs, model, carry=True)
    assert carried.columns == [*edge_docs.columns, "__lang_pred", "__score"]
    assert byte_cnn_lang.identify(no_docs).collect() == []
    assert {r["lang_pred"] for r in byte_cnn_lang.predict(edge_docs, None).collect()} == {"und"}


def test_convolution_by_tables_is_a_convolution():
    m = byte_cnn_lang.ByteCNN(["a", "b"], filters=2, window=16)
    x = m.windows(b"some bytes here")
    padded = np.concatenate([x[0], np.zeros(4, np.uint8)])
    y = m.convolve(x)[0]
    widest = [w for w in sorted(byte_cnn_lang.WIDTHS, reverse=True) for _ in range(2)]
    for i in range(16):
        for f, width in enumerate(widest):
            assert y[i, f] == pytest.approx(sum(m.tables[k][padded[i + k], f] for k in range(width)), abs=1e-4)


def test_op5(spark, edge_docs, no_docs):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    from pulsekit.session import shared_dir

    shared_dir(spark)
    model = gbt_toxicity.train(docs, labels)
    got = gbt_toxicity.score(docs, model).join(labels, "doc_id").where(gbt_toxicity.held_out()).toPandas()
    toxic, clean = got[got.toxic == 1].score.to_numpy(), got[got.toxic == 0].score.to_numpy()
    assert ((toxic[:, None] > clean[None]) + 0.5 * (toxic[:, None] == clean[None])).mean() > 0.95
    assert (got.predicted == got.toxic).mean() > 0.97
    edge = gbt_toxicity.score(edge_docs, model).collect()
    assert len(edge) == edge_docs.count() and all(0 <= r["score"] <= 1 for r in edge)
    assert gbt_toxicity.score(no_docs, model).collect() == []
    strange = spark.createDataFrame([(5, None), (5, 1), (None, 1), (99, 0)], "doc_id long, toxic int")
    assert gbt_toxicity.train(edge_docs, strange) is None
    assert all(r["score"] == 0 for r in gbt_toxicity.toxicity(edge_docs, strange).collect())


def test_isotonic():
    x, y = gbt_toxicity.isotonic(np.array([1.0, 2, 3, 4]), np.array([0.0, 1, 0, 1]))
    assert (np.diff(x) > 0).all() and (np.diff(y) > 0).all() and 0 < y[0] and y[-1] < 1


def test_language_sample_of_null_ids_and_one_text(spark):
    docs = spark.range(50_000).select(
        F.lit(None).cast("long").alias("doc_id"),
        F.when(F.col("id") % 2 == 0, F.concat(F.lit("zz yy "), F.col("id").cast("string")))
        .otherwise(F.lit("qq ww ee")).alias("text"),
        F.when(F.col("id") % 2 == 0, F.lit("a")).otherwise(F.lit("b")).alias("lang"))
    model = byte_cnn_lang.train(docs, F.lit(True), docs_per_lang=100)
    assert model.classes == ["a", "b"]
    got = byte_cnn_lang.predict(docs.where("lang = 'b'"), model).groupBy("lang_pred").count().collect()
    assert {r["lang_pred"]: r["count"] for r in got} == {"b": 25_000}
    got = byte_cnn_lang.predict(docs.where("lang = 'a'"), model).select("lang_pred").distinct().collect()
    assert [r["lang_pred"] for r in got] == ["a"]
    # the most frequent languages only
    assert byte_cnn_lang.train(docs.where("lang = 'b' or text like '%2'"), F.lit(True), most_langs=1).classes == ["b"]


def test_language_names_that_clash(spark):
    rows = [(1, "some words", "en", "mine", 7.0, "x", "y"), (2, None, "en", "mine", 8.0, "x", "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, __lang_pred string, "
                                       "__score double, __text string, __TEXT_ string")
    model = byte_cnn_lang.train(docs, F.lit(True))
    carried = byte_cnn_lang.predict(docs, model, carry=True)
    assert carried.columns == [*docs.columns, *byte_cnn_lang.carried_names(docs)] and len(set(carried.columns)) == 9
    assert sorted(tuple(r)[:7] for r in carried.collect()) == rows


def test_orders_below_are_joined_once(spark):
    ngrams = kn_quality.count_ngrams(spark.createDataFrame([("abcabd abe",)], "text string"), 3)
    model = kn_quality.Model(ngrams, 3, job_dir(spark, "test-kn"))
    asked = spark.createDataFrame([(g,) for g in kn_quality.ngram_keys(b"abcxbd", 3).tolist()], "g long")
    plan = model.log_probabilities(asked)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") <= 1          # the other orders' are written
