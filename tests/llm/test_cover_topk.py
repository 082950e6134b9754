import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsekit.llm import cover_topk

VECTORS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())),
                        T.StructField("score", T.DoubleType()), T.StructField("cell", T.IntegerType()),
                        T.StructField("query_id", T.StringType())])


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, None, 0, "q") for i, v in rows], VECTORS)


def brute(rows, queries, k, scale=256):
    """All pairs in whole numbers."""
    ok = [(i, [int(np.floor(scale * x)) for x in v]) for i, v in rows
          if i is not None and v is not None and all(x is not None and np.isfinite(x) and abs(scale * x) < 2 ** 53 for x in v)]
    out = {}
    for q in sorted({i for i, _ in ok if i in queries}):
        v = min(w for i, w in ok if i == q)
        best = {}
        for i, w in ok:
            if i != q and len(w) == len(v):
                best[i] = max(best.get(i, -1 << 200), sum(a * b for a, b in zip(v, w)))
        near = sorted((-s, i) for i, s in best.items())[:k]
        if near:
            out[q] = [(i, max(min(-s, (1 << 63) - 1), -(1 << 63))) for s, i in near]
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert all([r for r, _, _ in v] == list(range(1, len(v) + 1)) for v in out.values())
    return {q: [(i, s) for _, i, s in v] for q, v in out.items()}


SMALL = dict(cell_rows=32, sample_rows=200, block_rows=3, leaf=8)


@pytest.mark.parametrize("options", [{}, SMALL])
def test_op11_equals_all_pairs(spark, options):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 9))
    # clusters of unlike norms, whole values (many ties) and one vector many times
    x = centres[rng.integers(0, 12, 700)] * rng.integers(1, 4, (700, 1)) + rng.normal(scale=0.1, size=(700, 9))
    x[100:300] = np.round(x[100:300])
    x[300:500] = x[0]
    rows = [(int(i), v.tolist()) for i, v in zip(rng.permutation(700), x)]
    queries = {i for i in range(700) if i % 7 == 0}
    got = found(cover_topk.search(vectors(spark, rows).repartition(5), F.col("vec_id") % 7 == 0, **options))
    assert got == brute(rows, queries, 5)


@pytest.mark.parametrize("options", [{}, SMALL])
def test_op11_odd_rows(spark, options):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 1.0]), (4, [0.0, 0.0]), (5, None),
            (6, [nan, 1.0]), (7, [inf, 1.0]), (8, [None, 1.0]), (9, []), (20, []), (10, [1.0, 1.0]), (10, [1.0, 1.0]),
            (10, [-1.0, 3.0]), (11, [1.0, 0.0, 0.0]), (None, [1.0, 0.0]), (12, [1e200, 0.0]), (13, [1e12, -1e12]),
            (14, [-1e12, 1e12]), (15, [1e-300, -1e-300]), (30, [1e13, 1e13])]
    rows += [(100 + i, [1.0, 0.0]) for i in range(40)]
    got = found(cover_topk.search(vectors(spark, rows), F.col("vec_id") % 10 == 0, **options))
    assert got == brute(rows, {i for i in range(200) if i % 10 == 0}, 5)
    assert got[20] == [(9, 0)] and 12 not in got[0]


def test_op11_few_rows(spark):
    e = vectors(spark, [(0, [1.0, 2.0]), (1, [3.0, 4.0]), (50, [0.5, -0.1])])
    assert found(cover_topk.search(e, F.col("vec_id") == 0)) == {0: [(1, (256 * 3 + 512 * 4) * 256), (50, 128 * 256 - 26 * 512)]}
    assert cover_topk.search(e.where("vec_id = 0"), F.lit(True)).collect() == []
    assert cover_topk.search(e.limit(0), F.lit(True)).collect() == []
    assert cover_topk.search(e, F.lit(False)).collect() == []


def test_cover_tree_invariants():
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.normal(size=(400, 3)), rng.normal(scale=0.01, size=(200, 3)), np.zeros((50, 3))])
    tree = cover_topk.CoverTree(x, 10)
    assert sorted(tree.order.tolist()) == list(range(650))
    for node, kids in enumerate(tree.children):
        rows = tree.order[tree.begin[node]:tree.end[node]]
        dist = np.sqrt(((x[rows] - tree.centres[node]) ** 2).sum(axis=1))
        assert dist.max() <= tree.radii[node] + 1e-12 and tree.centre[node] in rows
        if kids:
            scale = tree.radius[node] / cover_topk.BASE
            assert tree.centre[kids[0]] == tree.centre[node]                     # nesting
            assert all(tree.radius[c] <= scale for c in kids)                    # covering
            c = x[[tree.centre[k] for k in kids]]
            gaps = np.sqrt(((c[:, None] - c[None]) ** 2).sum(axis=2))[~np.eye(len(kids), dtype=bool)]
            assert gaps.min() > scale                                            # separation
            assert [tree.begin[kids[0]], tree.end[kids[-1]]] == [tree.begin[node], tree.end[node]]


def test_op11_prunes():
    """Far clusters are not compared."""
    rng = np.random.default_rng(6)
    x = np.concatenate([rng.integers(-20, 20, (500, 4)) + 5000 * c for c in np.eye(4, dtype=int)])
    shard = cover_topk.DataShard([[i] for i in range(len(x))], x, 16)
    seen = []
    compare = shard._compare
    shard._compare = lambda x_, rows, lo, hi, first, last, best: (seen.append((hi - lo) * (last - first)),
                                                                 compare(x_, rows, lo, hi, first, last, best))
    best = cover_topk.Best(list(range(0, 500, 10)), [None] * 50, 5)
    shard.search(x[0:500:10], best, 8)
    assert sum(seen) < 50 * len(x) / 3
    for q, top in zip(range(0, 500, 10), best.top):
        assert top == sorted((-int(x[q] @ v), i) for i, v in enumerate(x) if i != q)[:5]


def test_op11_matches_its_sql(spark):
    from pulsekit.llm.queries import ORACLE, QUERIES
    from tools.oracle_check import compare, duck

    sf = "/root/testdata/sf0.001"
    assert compare(QUERIES["op11_cover_topk"](spark, sf).toPandas(), duck(sf).sql(ORACLE["op11_cover_topk"]).df()) is None
