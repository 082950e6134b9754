"""Operator 8: nearest vectors by cosine through stable random projections.

Unit vectors are projected to ``dims`` Gaussian (2-stable) coordinates: the
squared projected distance over the squared true distance is chi-square with
``dims`` degrees of freedom.  A kd-tree over the projections yields neighbours in
ascending projected distance; each is verified by its true cosine, and the
search stops when the next projected distance p fails the test
chi2(p^2 / d^2) <= ``confidence``, d being the k-th true distance so far.  A true
neighbour is then missed with a probability of at most 1 - ``confidence``.

The tree's upper levels are cut from a bounded sample (``sample_rows``) and known
to all tasks: their leaves are cells, and all rows are put into cells, cells of
many rows in several shards.  Equal vectors are one entry with their smallest
ids, collapsed before they move, so copies don't fill a shard.  A query first
searches its own cell; the distance found says which other cells the test can't
rule out, and only those are searched next.  Each shard holds its tree and
streams the queries that come to it; results are merged by (score, id).

Vectors that are null, empty, zero, or hold a null or a non-finite component
take no part; only vectors of one dimension are compared.  Ties go to smaller
ids; vectors of any finite magnitude are scaled by powers of two first, so a huge or
tiny one scores like any other; rows repeated with one vec_id count once; a null vec_id is no row to find.
Fewer candidates than k give fewer rows; a table without rows gives none.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsekit.session import ship
from pulsekit.llm.common import job_dir, written


def chi_square(x: float, dims: int) -> float:
    """Distribution function for an even number of degrees of freedom."""
    term = total = 1.0
    for i in range(1, dims // 2):
        term *= x / 2 / i
        total += term
    return 1 - math.exp(-x / 2) * total


def chi_square_limit(p: float, dims: int) -> float:
    lo, hi = 0.0, 1e3
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if chi_square(mid, dims) < p else (lo, mid)
    return hi


def projection(dims_in: int, dims: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, dims_in]).normal(size=(dims_in, dims))


class KDTree:
    """Leaves of at most ``leaf`` points with their boxes."""

    def __init__(self, points: np.ndarray, leaf: int):
        self.leaves: list[np.ndarray] = []
        todo = [np.arange(len(points))]
        while todo:
            rows = todo.pop()
            if len(rows) <= leaf:
                self.leaves.append(rows)
                continue
            axis = int(np.ptp(points[rows], axis=0).argmax())
            half = len(rows) // 2
            order = np.argpartition(points[rows, axis], half)
            todo += [rows[order[:half]], rows[order[half:]]]
        self.low = np.array([points[r].min(axis=0) for r in self.leaves])
        self.high = np.array([points[r].max(axis=0) for r in self.leaves])

    def box_distances(self, q: np.ndarray) -> np.ndarray:
        """Squared distance of a point to every leaf's box."""
        d = np.maximum(np.maximum(self.low - q, q - self.high), 0)
        return (d * d).sum(axis=1)


class Cells:
    """Upper levels of the tree: splits by (axis, value), leaves are cells."""

    def __init__(self, points: np.ndarray, n_cells: int):
        self.nodes: list[tuple[int, float, int, int]] = []   # axis, value, left, right; axis -1: cell
        self.boxes: list[tuple[np.ndarray, np.ndarray]] = []
        dims = points.shape[1]
        self._split(points, n_cells, np.full(dims, -np.inf), np.full(dims, np.inf))
        self.low = np.array([b[0] for b in self.boxes])
        self.high = np.array([b[1] for b in self.boxes])

    def _split(self, points, n_cells, low, high) -> int:
        node = len(self.nodes)
        if n_cells <= 1 or len(points) < 2:
            self.nodes.append((-1, 0.0, len(self.boxes), 0))
            self.boxes.append((low, high))
            return node
        self.nodes.append((0, 0.0, 0, 0))
        axis = int(points.var(axis=0).argmax())
        left = n_cells // 2
        value = float(np.quantile(points[:, axis], left / n_cells))
        below, above = high.copy(), low.copy()
        below[axis] = above[axis] = value
        side = points[:, axis] < value
        a = self._split(points[side], left, low, below)
        b = self._split(points[~side], n_cells - left, above, high)
        self.nodes[node] = (axis, value, a, b)
        return node

    def of(self, points: np.ndarray) -> np.ndarray:
        out = np.zeros(len(points), np.int32)
        todo = [(0, np.arange(len(points)))]
        while todo:
            node, rows = todo.pop()
            axis, value, a, b = self.nodes[node]
            if axis < 0:
                out[rows] = a
            else:
                side = points[rows, axis] < value
                todo += [(a, rows[side]), (b, rows[~side])]
        return out

    def near(self, q: np.ndarray, radius2: float) -> np.ndarray:
        d = np.maximum(np.maximum(self.low - q, q - self.high), 0)
        return np.flatnonzero((d * d).sum(axis=1) <= radius2)


def valid_vectors(embeddings: DataFrame) -> DataFrame:
    """vec_id and vec (doubles) of the rows that take part."""
    ship(embeddings.sparkSession)
    vec = F.col("embedding").cast("array<double>")
    ok = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) \
        & F.exists(vec, lambda x: x != 0)
    return (embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), vec.alias("vec"))
            .where(F.col("vec_id").isNotNull() & F.col("vec").isNotNull()).where(ok))


def matrix(col: pa.Array) -> np.ndarray:
    return np.asarray(col.flatten()).reshape(len(col), -1)


def by_dimension(b: pa.RecordBatch, column: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, their vectors) for each dimension in a batch."""
    col = b.column(column)
    sizes = np.asarray(col.value_lengths())
    for n in np.unique(sizes):
        rows = np.flatnonzero(sizes == n)
        yield rows, matrix(col.take(pa.array(rows)))


def unit(x: np.ndarray) -> np.ndarray:
    x = scaled(x)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows times a power of two that brings the largest component to 0.5 .. 1: the
    same cosines to the last bit, without overflow or underflow of the squares."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])


ENTRY = "cell int, shard int, kind int, ids array<long>, vec array<double>, bound double"


def search(embeddings: DataFrame, is_query, k: int = 5, dims: int = 12, confidence: float = 0.985,
           sample_rows: int = 20_000, cell_rows: int = 8_192, seed: int = 17) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of every row for which
    ``is_query`` (a column over vec_id) holds, among all other rows."""
    spark = embeddings.sparkSession
    rows = valid_vectors(embeddings)
    limit = chi_square_limit(confidence, dims)
    n = rows.count()
    wanted = max(1, -(-n // cell_rows))
    share = min(1.0, 0.8 * sample_rows / max(1, n))

    def projected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for _, x in by_dimension(b, 0):
                p = unit(x + 0.0) @ projection(x.shape[1], dims, seed)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x.shape[1]] * len(x), pa.int32()), pa.array(p.tolist(), pa.list_(pa.float64()))],
                    names=["size", "point"])

    # at most sample_rows points of ``dims`` coordinates come to the driver
    sample = (rows.where(F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.lit(1 << 20)) < share * (1 << 20))
              .select("vec").mapInArrow(projected, "size int, point array<double>")
              .distinct().limit(sample_rows).toArrow())
    size_of = np.asarray(sample.column("size"))
    points = np.array(sample.column("point").to_pylist(), float).reshape(-1, dims)
    cells = {int(size): Cells(points[size_of == size], min(wanted, max(1, int((size_of == size).sum()) // 16)))
             for size in np.unique(size_of)}
    n_shards = max(1, -(-n // (cell_rows * sum((len(c.boxes) for c in cells.values()), 0) or 1)))

    def cell_of(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        p = unit(x) @ projection(x.shape[1], dims, seed)
        c = cells.get(x.shape[1])
        return p, (c.of(p) if c else np.zeros(len(p), np.int32))

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Equal vectors of a batch as one entry with its k + 1 smallest ids."""
        for b in batches:
            ids = np.asarray(b.column(0))
            for at, x in by_dimension(b, 1):
                x = x + 0.0                                # no negative zeros
                keys = [r.tobytes() for r in x]
                groups: dict[bytes, list[int]] = {}
                for i, key in zip(at[np.argsort(ids[at], kind="stable")].tolist(),
                                  (keys[j] for j in np.argsort(ids[at], kind="stable").tolist())):
                    own = groups.setdefault(key, [])
                    if len(own) <= k and (not own or own[-1] != ids[i]):
                        own.append(int(ids[i]))
                v = np.frombuffer(b"".join(groups), np.float64).reshape(len(groups), -1)
                _, cell = cell_of(v)
                shard = np.array([int.from_bytes(np.uint64(abs(hash_of(r))).tobytes()[:4], "little") % n_shards
                                  for r in v], np.int32)
                yield batch_of(cell, shard, 0, list(groups.values()), v, np.full(len(v), np.nan))

    def batch_of(cell, shard, kind, ids, v, bound) -> pa.RecordBatch:
        flat = pa.array(v.ravel(), pa.float64())
        off = pa.array(np.arange(len(v) + 1, dtype=np.int32) * (v.shape[1] if len(v) else 0))
        return pa.RecordBatch.from_arrays(
            [pa.array(cell, pa.int32()), pa.array(shard, pa.int32()), pa.array(np.full(len(v), kind), pa.int32()),
             pa.array(ids, pa.list_(pa.int64())), pa.ListArray.from_arrays(off, flat), pa.array(bound, pa.float64())],
            names=["cell", "shard", "kind", "ids", "vec", "bound"])

    def ask(home: bool):
        """Queries as entries of the cells they go to: their own (home), or the
        others that the test leaves open, with the bound found at home."""
        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                ids = np.asarray(b.column(0))
                bounds = np.full(len(ids), np.inf) if home else np.asarray(b.column(2))
                for at, x in by_dimension(b, 1):
                    p, own = cell_of(x)
                    c = cells.get(x.shape[1])
                    if home or c is None:
                        hit, cell = np.arange(len(own)) if home else np.zeros(0, int), own if home else own[:0]
                    else:
                        near = [np.setdiff1d(c.near(q, limit * d), [o]) for q, d, o in zip(p, bounds[at], own)]
                        hit = np.repeat(np.arange(len(near)), [len(v) for v in near])
                        cell = np.concatenate([np.zeros(0, np.int32), *near]).astype(np.int32)
                    shard = np.tile(np.arange(n_shards, dtype=np.int32), len(hit))
                    hit, cell = np.repeat(hit, n_shards), np.repeat(cell, n_shards)
                    for lo in range(0, len(hit), 5000):
                        s = slice(lo, lo + 5000)
                        yield batch_of(cell[s], shard[s], 1, ids[at][hit[s], None].tolist(), x[hit[s]], bounds[at][hit[s]])
        return work

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of a shard come together: its entries, then its queries."""
        shard, parts, indexes = None, [], None
        for batch in batches:
            cell, sub, kind = (np.asarray(batch.column(i)) for i in range(3))
            cuts = np.flatnonzero(np.diff(cell) | np.diff(sub) | np.diff(kind)) + 1
            for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
                b = batch.slice(lo, hi - lo)
                if shard != (cell[lo], sub[lo]):
                    shard, parts, indexes = (cell[lo], sub[lo]), [], None
                if kind[lo] == 0:
                    parts.append(b.select(["ids", "vec"]))
                    continue
                if indexes is None:
                    indexes = build(parts)
                found = []
                for at, x in by_dimension(b, 4):
                    index = indexes.get(x.shape[1])
                    if index:
                        ids = b.column(3).flatten().to_numpy()[at].tolist()
                        bound = np.asarray(b.column(5))[at].tolist()
                        found += [f for q, v, d in zip(ids, x, bound) for f in index.nearest(q, v, d)]
                if found:
                    q, v, s = zip(*found)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(q, pa.int64()), pa.array(v, pa.int64()), pa.array(s, pa.float64())],
                        names=["query_id", "vec_id", "score"])

    def build(parts: list[pa.RecordBatch]) -> dict[int, "Shard"]:
        groups: dict[bytes, set[int]] = {}
        for b in parts:
            for ids, v in zip(b.column(0).to_pylist(), b.column(1)):
                groups.setdefault(np.asarray(v.values).tobytes(), set()).update(ids)
        sizes: dict[int, list[bytes]] = {}
        for key in groups:
            sizes.setdefault(len(key) // 8, []).append(key)
        return {size: Shard([sorted(groups[key])[:k + 1] for key in keys],
                            np.frombuffer(b"".join(keys), np.float64).reshape(-1, size),
                            projection(size, dims, seed), limit, k)
                for size, keys in sizes.items()}

    folder = job_dir(spark, "neighbours")
    index = written(rows.mapInArrow(entries, ENTRY), folder, "entries")
    queries = rows.where(is_query).dropDuplicates(["vec_id"])

    def searched(asked: DataFrame) -> DataFrame:
        return (index.unionByName(asked).repartition("cell", "shard")
                .sortWithinPartitions("cell", "shard", "kind")
                .mapInArrow(answer, "query_id long, vec_id long, score double"))

    at_home = written(searched(queries.mapInArrow(ask(True), ENTRY)), folder, "home")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    # squared distance of unit vectors to the k-th found; unbounded with fewer
    bounds = (at_home.withColumn("rank", F.row_number().over(best)).where(F.col("rank") == k)
              .select("query_id", (2 - 2 * F.col("score")).alias("bound")))
    bounded = (queries.join(bounds, queries.vec_id == bounds.query_id, "left")
               .select("vec_id", "vec", F.coalesce("bound", F.lit(float("inf"))).alias("bound")))
    away = searched(bounded.mapInArrow(ask(False), ENTRY))
    return (at_home.unionByName(away).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def hash_of(row: np.ndarray) -> int:
    import zlib

    return zlib.crc32(row.tobytes())


class Shard:
    """Distinct vectors of a shard with their ids, and the tree over their
    projections."""

    def __init__(self, ids: list[list[int]], x: np.ndarray, project: np.ndarray, limit: float, k: int,
                 leaf: int = 256):
        tree = KDTree(unit(x) @ project, leaf)
        order = np.concatenate(tree.leaves)
        self.tree, self.limit, self.k, self.project = tree, limit, k, project
        self.ids = [ids[i] for i in order]
        self.x = scaled(x[order])
        self.norm = np.sqrt((self.x * self.x).sum(axis=1))
        self.p = unit(self.x) @ project
        self.cut = np.concatenate([[0], np.cumsum([len(r) for r in tree.leaves])])

    def nearest(self, query_id: int, v: np.ndarray, bound: float) -> list[tuple[int, int, float]]:
        """(query, id, score) of the k best; ``bound``: a squared distance that
        k known rows elsewhere reach."""
        q = (unit(v[None]) @ self.project)[0]
        v = scaled(v[None])[0]
        norm = math.sqrt(float(v @ v))
        box = self.tree.box_distances(q)
        top: list[tuple[float, int]] = []                 # (-score, id), ascending
        for leaf in np.argsort(box, kind="stable").tolist():
            if box[leaf] > self.limit * bound:
                break
            lo, hi = self.cut[leaf], self.cut[leaf + 1]
            diff = self.p[lo:hi] - q
            rows = lo + np.flatnonzero((diff * diff).sum(axis=1) <= self.limit * bound)
            score = (self.x[rows] @ v) / (self.norm[rows] * norm)
            for s, i in zip(score.tolist(), rows.tolist()):
                if len(top) < self.k or -s <= top[-1][0]:
                    top += [(-s, j) for j in self.ids[i] if j != query_id]
                    top = sorted(top)[:self.k]
            if len(top) == self.k:
                bound = min(bound, max(0.0, 2 + 2 * top[-1][0]))
        return [(query_id, j, -s) for s, j in top]
