"""Operators 4, 7 and 8 against brute force."""

import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsekit.llm import ann_projection, jaccard_join, lz_fingerprint
from tests.llm.conftest import frame


def naive_phrases(text):
    seen, s = [], 0
    for e in range(1, len(text) + 1):
        if text[s:e] not in seen:
            seen.append(text[s:e])
            s = e
    return set(seen)


@pytest.mark.parametrize("text", ["", "a", "aaaaaaaa", "abababab", "The cat sat on the mat. " * 9, "日本日本日本語"])
def test_lz_parse(text):
    p = lz_fingerprint.Parsed(1, text, 16)
    assert p.seen == naive_phrases(text)
    edited, f = lz_fingerprint.Parsed(1, text, 16).edited("xyz and more of it")
    assert (f == lz_fingerprint.Parsed(1, edited, 16).print).all()


def test_lz_likeness_is_jaccard_for_small_sets():
    a, b = np.array([1, 2, 3, 4], np.uint32), np.array([3, 4, 5], np.uint32)
    assert lz_fingerprint.likeness(a, b, 128) == 2 / 5
    assert lz_fingerprint.likeness(a[:0], a[:0], 128) == 1.0
    assert lz_fingerprint.likeness(a, a[:0], 128) == 0.0


@pytest.mark.parametrize("name", ["edge_docs", "small_docs"])
def test_op4(name, request):
    docs = request.getfixturevalue(name)
    rows = sorted(((r["doc_id"], r["text"] or "") for r in docs.select("doc_id", "text").collect()),
                  key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    want = []
    for k, (doc, text) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        cut = len(text) // 4
        edited = text[:len(text) - cut] + after[:cut]
        p, e, n = (lz_fingerprint.Parsed(0, t, 128).print for t in (text, edited, after))
        want.append((doc, len(text), hashlib.sha256(edited.encode()).hexdigest(), lz_fingerprint.as_string(p),
                     lz_fingerprint.as_string(e), lz_fingerprint.likeness(p, e, 128), lz_fingerprint.likeness(p, n, 128)))
    got = [tuple(r) for r in lz_fingerprint.edited_likeness(docs).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_lz_tells_edited_texts_from_others(small_docs):
    got = lz_fingerprint.edited_likeness(small_docs.where("n_chars > 300")).toPandas()
    assert (got.near_edited > got.near_next).mean() > 0.97


def shingle_set(text, words):
    w = [x for x in re.split(rb"[\x20\x09-\x0d]+", (text or "").encode().lower()) if x]
    return frozenset(tuple(w[i:i + words]) for i in range(max(1, len(w) - words + 1))) if w else frozenset()


def brute_components(rows, words, num, den):
    sets = [shingle_set(t, words) for _, t in rows]
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and den * len(sets[i] & sets[j]) >= num * len(sets[i] | sets[j]):
                up[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            r = find(i)
            least[r] = min(least.get(r, doc), doc)
    return [(doc, len(s), least.get(find(i)) if s else doc) for i, ((doc, _), s) in enumerate(zip(rows, sets))]


CONTRACT, HARD = (4, 85, 100, 64, 20), (3, 30, 100, 3, 8)


@pytest.mark.parametrize("name,words,num,den,list_rows,bits", [
    ("edge_docs", *CONTRACT), ("small_docs", *HARD), ("copies", *CONTRACT), ("copies", *HARD)])
def test_op7(name, words, num, den, list_rows, bits, spark, request):
    if name == "copies":
        rng = np.random.default_rng(3)
        base = [f"w{i}" for i in range(60)]
        rows = []
        for k in range(90):                                # a large group of copies, with edits
            w = list(base)
            for i in rng.integers(0, 60, rng.integers(0, 5)):
                w[i] = f"x{rng.integers(1000)}"
            rows.append((k, " ".join(w[:60 - int(rng.integers(0, 3))]), "en"))
        docs = frame(spark, rows)
    else:
        docs = request.getfixturevalue(name)
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    got = jaccard_join.join(docs, words, num, den, list_rows, bits).collect()
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got), key=repr) == \
        sorted(brute_components(rows, words, num, den), key=repr)
    stay = {(r["doc_id"], r["text_key"]) for r in got if r["stays"] and r["n_shingles"]}
    assert len(stay) == len({r["component_id"] for r in got if r["n_shingles"]})


def brute_links(rows, words, num, den):
    """(doc_id, shingles, other sets that link) of every row."""
    sets = []
    for _, text in rows:
        w = re.findall(rb"[^\x20\x09-\x0d]+", (text or "").encode().lower())
        k = min(words, len(w))
        sets.append(frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if w else frozenset())
    other = set(sets) - {frozenset()}
    return [(i, len(s), sum(s != o and den * len(s & o) >= num * len(s | o) for o in other) if s else 0)
            for (i, _), s in zip(rows, sets)]


@pytest.mark.parametrize("num,list_rows,block", [(17, 4, 8), (17, 64, 1024), (12, 4, 16)])
def test_op7_links_are_all_links(num, list_rows, block, spark):
    rng = np.random.default_rng(5)
    rows = []
    for g in range(3):                                     # a large group of near copies, and smaller ones
        for _ in range((150, 20, 3)[g]):
            w = [f"{g}w{i}" for i in range(80)]
            for i in rng.integers(0, 80, rng.integers(0, 4)):
                w[i] = f"x{rng.integers(1000)}"
            rows.append((len(rows), " ".join(w[:80 - int(rng.integers(0, 20))]), "en"))
    rows += [(900, rows[0][1], "en"), (901, "", "en"), (902, None, "en"), (903, "one", "en"), (None, rows[1][1], "en")]
    got = jaccard_join.links(frame(spark, rows), 4, num, 20, list_rows, block=block).collect()
    want = brute_links([(i, t) for i, t, _ in rows], 4, num, 20)
    assert sorted(((r["doc_id"], r["n_shingles"], r["links"]) for r in got), key=repr) == sorted(want, key=repr)
    seen = jaccard_join.join(frame(spark, rows), 4, num, 20, list_rows).agg(F.sum("links_seen")).first()[0]
    assert sum(x[2] for x in want) > seen or list_rows == 64


def test_op7_a_long_list_is_dealt_by_blocks(spark):
    """Texts that share a passage and don't link: no task compares more than two blocks."""
    rows = [(t, 100 + k % 40, 0, 7919 * k + t, 7919 * k + t) for t in (1, 2) for k in range(400)]
    rows += [(3, 50, 0, k, 5) for k in range(30)]          # of one label: nothing to do
    lists = spark.createDataFrame(rows, "token long, n int, pos int, key long, label long")
    folder = jaccard_join.job_dir(spark, "test-jaccard")
    got = jaccard_join.differing(lists, 17, 20, folder, block=16)
    n = {t: [(k, m) for u, m, _, k, _ in rows if u == t] for t in (1, 2)}
    want = {(min(a, b), max(a, b)) for t in n for a, x in n[t] for b, y in n[t]
            if a < b and 20 * min(x, y) >= 17 * max(x, y)}
    found = [(r["a"], r["b"]) for r in got.collect()]
    assert set(found) == want and len(found) == len(want)
    cells = jaccard_join.in_cells(lists, "token", 17, 20, F.count("*") / F.lit(16), folder, "again")
    cells = cells.select("token", F.explode("cells").alias("c")).groupBy("token", "c.lo", "c.i", "c.next", "c.j").count()
    assert cells.agg(F.max("count")).first()[0] < 4 * 16


def test_op7_links_match_their_sql(spark, no_docs):
    from pulsekit.llm.queries import ORACLE, QUERIES
    from tools.oracle_check import compare, duck

    sf = "/root/testdata/sf0.001"
    assert compare(QUERIES["jaccard_links"](spark, sf).toPandas(), duck(sf).sql(ORACLE["jaccard_links"]).df()) is None
    assert jaccard_join.links(no_docs).collect() == []


def test_op7_tells_words_apart_that_polynomials_confuse():
    """Thue-Morse words of 1,024 letters and their complements, and blocks of zeros."""
    word = "a"
    while len(word) < 1024:
        word += word.translate(str.maketrans("ab", "ba"))
    texts = [word, word.translate(str.maketrans("ab", "ba")), word[:512], "\0", "\0\0", "\0" * 8, "\0" * 9, "a\0" * 8, word + " a", "A" * 8]
    texts += ["x" * n for n in (1, 7, 8, 9, 15, 16, 17, 3000)]
    doc, h = jaccard_join.shingles([t.encode() for t in texts], 4)
    assert len(doc) == len(texts) and len(set(h.tolist())) == len(texts)
    again = jaccard_join.shingles([t.encode() for t in reversed(texts)], 4)[1]
    assert again.tolist() == h.tolist()[::-1]
    lower = jaccard_join.shingles([b"a" * 8, b"A" * 8], 4)[1]
    assert lower[0] == lower[1]


def test_op7_no_rows(no_docs):
    assert jaccard_join.join(no_docs).collect() == []
    assert lz_fingerprint.edited_likeness(no_docs).collect() == []


VECTORS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                        T.StructField("score", T.DoubleType()), T.StructField("label", T.IntegerType())])


def brute_nearest(rows, queries, k):
    out = {}
    for q, v in rows:
        if q in queries:
            v = np.array(v, float)
            near = sorted((-float(np.dot(v, np.array(w, float))) / float(np.linalg.norm(v) * np.linalg.norm(w)), i)
                          for i, w in rows if i != q and len(w) == len(v))
            out[q] = [(i, -s) for s, i in near[:k]]
    return out


def test_op8_recall(spark):
    e = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in e.collect()]
    want = brute_nearest(rows, {i for i, _ in rows if i % 50 == 0}, 5)
    got = {}
    for r in ann_projection.search(e, F.col("vec_id") % 50 == 0, cell_rows=256).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    hit = sum(len({i for i, _ in v} & {i for i, _ in got[q].values()}) for q, v in want.items())
    assert hit >= 0.93 * sum(map(len, want.values()))
    for q, found in got.items():
        assert sorted(found) == [1, 2, 3, 4, 5]
        scores = [found[r][1] for r in range(1, 6)]
        assert scores == sorted(scores, reverse=True)


def test_op8_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 1.0]), (4, [0.0, 0.0]), (5, None),
            (6, [nan, 1.0]), (7, [inf, 1.0]), (8, [None, 1.0]), (9, []), (10, [1.0, 1.0]), (10, [1.0, 1.0]),
            (11, [1.0, 0.0, 0.0]), (None, [1.0, 0.0])] + [(100 + i, [1.0, 0.0]) for i in range(40)]
    e = spark.createDataFrame([(i, v, None, 0) for i, v in rows], VECTORS)
    got = {}
    for r in ann_projection.search(e, F.col("vec_id") % 10 == 0, k=5).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], round(r["score"], 9)))
    assert got[0] == [(1, 1.0), (2, 1.0), (100, 1.0), (101, 1.0), (102, 1.0)]
    assert got[10][0][0] in (0, 3) and len(got[10]) == 5 and 10 not in [i for i, _ in got[10]]
    assert ann_projection.search(e.where("vec_id in (4, 5, 9)"), F.lit(True)).collect() == []
    assert [r["vec_id"] for r in ann_projection.search(e.where("vec_id in (0, 3)"), F.col("vec_id") == 0).collect()] == [3]


DOUBLES = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType()))])


def test_op8_magnitudes(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(60, 6))
    sizes = [1.0, 1e200, 1e-170, 1e300, 1e-300]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    e = spark.createDataFrame([(i, (np.array(v) * sizes[i % 5]).tolist()) for i, v in rows]
                              + [(100, [5e-324] * 6), (101, [1.7e308] * 6)], DOUBLES)
    rows += [(100, [1.0] * 6), (101, [1.0] * 6)]
    want = brute_nearest(rows, {i for i, _ in rows}, 5)
    got = {}
    for r in ann_projection.search(e, F.lit(True), confidence=0.999999).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert {q: [i for i, _ in v] for q, v in got.items()} == {q: [i for i, _ in v] for q, v in want.items()}
    assert all(abs(s - t) < 1e-12 for q in got for (_, s), (_, t) in zip(got[q], want[q]))


def test_scaling_leaves_cosines_as_they_are():
    x = np.random.default_rng(5).normal(size=(50, 16))
    y = ann_projection.scaled(x)
    plain = (x @ x[0]) / (np.sqrt((x * x).sum(axis=1)) * np.sqrt(x[0] @ x[0]))
    assert plain.tolist() == ((y @ y[0]) / (np.sqrt((y * y).sum(axis=1)) * np.sqrt(y[0] @ y[0]))).tolist()


def test_chi_square():
    assert abs(ann_projection.chi_square(ann_projection.chi_square_limit(0.95, 8), 8) - 0.95) < 1e-9
    assert abs(ann_projection.chi_square_limit(0.95, 2) - 5.991464547) < 1e-6


def test_links_read_texts_once_for_whole_sets(spark, monkeypatch):
    base = [f"w{i}" for i in range(60)]
    docs = spark.createDataFrame([(i, " ".join(base + [f"own{i}"])) for i in range(4)] + [(9, "some other words here")],
                                 "doc_id long, text string")
    read, whole_sets = [], jaccard_join.whole_sets
    monkeypatch.setattr(jaccard_join, "whole_sets", lambda *a, **k: read.append(1) or whole_sets(*a, **k))
    got = {r["doc_id"]: r["links"] for r in jaccard_join.links(docs, words=4, num=85, den=100).collect()}
    assert got == {0: 3, 1: 3, 2: 3, 3: 3, 9: 0}
    assert len(read) == 1
