"""Operator 11: exact top k by inner product, a dual-tree search of cover trees.

Vectors are turned into integers, floor(scale * x), and compared by their exact
inner product.  Queries and data are both held in cover trees: a node has a
centre that is one of its points (its first child keeps it), its children's
centres lie further apart than the node's scale and cover its points within that
scale, and the scale falls by ``BASE`` a level.  For a query node with centre a
and covering radius r, and a data node with centre b and radius s, no product
exceeds a.b + r|b| + s|a| + rs; the pair is pruned when that is below the worst
k-th score of the queries in the node.  Pairs are opened best bound first; leaves
are compared by a matrix product.  Nothing is missed: pruning is strict, so ties
are seen, and the bound has room for rounding.

Spark deals the trees' upper levels: the leaves of a cover tree over a bounded
sample (``sample_rows``) are cells.  Every row goes to the cell of the nearest
centre, whose true covering radius is aggregated from all its rows, and a cell is
cut by its own count into shards of about ``cell_rows``.  Queries of a cell travel
as blocks of ``block_rows``.  A block first asks one shard of its best cell; the
k-th scores found there prune (block, cell) pairs, and it then asks all shards of
the cells left open.  Each shard holds its tree and streams the blocks.

Equal vectors are one entry with their k + 1 smallest ids, collapsed before they
move.  Vectors that are null or hold a null or a non-finite component take no
part, nor do those with a scaled component of 2^53 or more, which doubles don't
hold exactly.  Only vectors of one length are compared; empty ones score 0, and
zero vectors take part.  Ties go to smaller ids.  Of rows repeated with one vec_id
the best counts as candidate and the least vector asks; a null vec_id is no row to
find.  A score beyond the range of a long shows as its nearest long, but is ranked
by its exact value.  Fewer candidates than k give fewer rows, no rows none.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsekit.session import ship
from pulsekit.llm.common import job_dir, release, written

BASE = 1.3
#: Doubles hold integers below this exactly.
EXACT = 1 << 53
#: A score travels as two longs, score = high * 2^62 + low.
LOW_BITS = 62


class CoverTree:
    """Over the rows of ``x`` (doubles).  ``order`` lists the rows so that a node's
    rows are ``order[begin:end]``; a node of at most ``leaf`` rows, or one that its
    next scale would shatter into more than a ``SHATTER``-th as many children, is
    not divided."""

    SHATTER = 12

    def __init__(self, x: np.ndarray, leaf: int):
        self.x = x
        self.centre: list[int] = []
        self.radius: list[float] = []
        self.begin: list[int] = []
        self.end: list[int] = []
        self.children: list[list[int]] = []
        order: list[np.ndarray] = []
        at = 0
        first = np.arange(len(x))
        todo = [(-1, first, 0, self._far(first, 0))] if len(x) else []
        while todo:                      # depth first, so that rows of a node are together
            parent, rows, centre, dist = todo.pop()
            node = len(self.centre)
            if parent >= 0:
                self.children[parent].append(node)
            self.centre.append(centre)
            self.radius.append(float(dist.max()))
            self.begin.append(at)
            self.end.append(at + len(rows))
            self.children.append([])
            parts = self._divide(rows, centre, dist) if len(rows) > leaf else []
            if parts:
                todo += [(node, *p) for p in reversed(parts)]
            else:
                order.append(rows)
                at += len(rows)
        self.order = np.concatenate(order) if order else np.zeros(0, np.int64)
        self.radii = np.array(self.radius) * (1 + 1e-9)
        self.centres = x[np.array(self.centre, np.int64)]
        self.norms = np.sqrt((self.centres * self.centres).sum(axis=1)) * (1 + 1e-9)

    def _far(self, rows: np.ndarray, centre: int) -> np.ndarray:
        d = self.x[rows] - self.x[centre]
        return np.sqrt((d * d).sum(axis=1))

    def _divide(self, rows, centre, dist) -> list[tuple[np.ndarray, int, np.ndarray]]:
        """Children (rows, centre, distances): each takes what is within the
        node's next scale of its centre, the next centre is the furthest row left."""
        scale = float(dist.max()) / BASE
        if scale == 0:
            return []
        parts, most = [], max(2, len(rows) // self.SHATTER)
        while True:
            near = dist <= scale
            parts.append((rows[near], centre, dist[near]))
            rows, dist = rows[~near], dist[~near]
            if not len(rows):
                return parts
            if len(parts) == most:
                return []
            centre = int(rows[dist.argmax()])
            dist = self._far(rows, centre)

    def leaves(self) -> list[int]:
        return [i for i, c in enumerate(self.children) if not c]


class Best:
    """The k best (-score, id) of each query of a block; ``known``: a score that
    k rows elsewhere reach."""

    def __init__(self, ids: list[int], known: list[int | None], k: int):
        self.ids, self.known, self.k = ids, known, k
        self.top: list[list[tuple[int, int]]] = [[] for _ in ids]
        self.least = np.array([-np.inf if s is None else _down(s) for s in known])

    def add(self, row: int, score: int, ids: list[int]) -> None:
        own, top = self.ids[row], self.top[row]
        for i in ids:
            if i == own or any(j == i and -s >= score for s, j in top):
                continue
            top = sorted([t for t in top if t[1] != i] + [(-score, i)])[:self.k]
        self.top[row] = top
        if len(top) == self.k:
            known = self.known[row]
            self.least[row] = _down(-top[-1][0] if known is None else max(known, -top[-1][0]))

    def worst(self) -> list[int | None]:
        return [-t[-1][0] if len(t) == self.k else s for t, s in zip(self.top, self.known)]


def _down(score: int) -> float:
    """A double not above an integer."""
    return float(score) if abs(score) < EXACT else float(np.nextafter(float(score), -np.inf))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of integer rows: in doubles while every sum stays
    exact, else in whole numbers of any size."""
    top = max(1, a.shape[1]) * int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0))
    if top < EXACT:
        return a.astype(float) @ b.astype(float).T
    return a.astype(object) @ b.astype(object).T


class DataShard:
    """Distinct integer vectors with their ids and the tree over them."""

    def __init__(self, ids: list[list[int]], x: np.ndarray, leaf: int):
        self.tree = CoverTree(x.astype(float), leaf)
        order = self.tree.order
        self.ids = [ids[i] for i in order.tolist()]
        self.x = x[order]

    def search(self, q: np.ndarray, best: Best, leaf: int) -> None:
        """Put this shard's rows into ``best`` of the queries ``q``."""
        qt, rt = CoverTree(q.astype(float), leaf), self.tree
        rows = qt.order
        x = q[rows]
        worst = [best.least[rows[b:e]].min() for b, e in zip(qt.begin, qt.end)]

        def bound(a: int, nodes: list[int]) -> np.ndarray:
            reach = (qt.norms[a] + qt.radii[a]) * (rt.norms[nodes] + rt.radii[nodes])
            return np.minimum(reach, rt.centres[nodes] @ qt.centres[a] + qt.radii[a] * rt.norms[nodes]
                              + rt.radii[nodes] * (qt.norms[a] + qt.radii[a])) + 1e-9 * reach + 0.5

        heap = [(-float(bound(0, [0])[0]), 0, 0)]
        while heap:
            most, a, b = heapq.heappop(heap)
            if -most < worst[a]:
                # what the node knows may be old: its queries may have found more
                continue
            worst[a] = best.least[rows[qt.begin[a]:qt.end[a]]].min()
            if -most < worst[a]:
                continue
            qa, rb = qt.children[a], rt.children[b]
            if rb and (not qa or rt.radii[b] >= qt.radii[a]):
                for s, c in zip(bound(a, rb).tolist(), rb):
                    if s >= worst[a]:
                        heapq.heappush(heap, (-s, a, c))
            elif qa:
                for c in qa:
                    s = float(bound(c, [b])[0])
                    if s >= worst[c]:
                        heapq.heappush(heap, (-s, c, b))
            else:
                self._compare(x, rows, qt.begin[a], qt.end[a], rt.begin[b], rt.end[b], best)

    def _compare(self, x, rows, lo, hi, first, last, best: Best) -> None:
        s = products(x[lo:hi], self.x[first:last])
        least = best.least[rows[lo:hi]]
        for r in np.flatnonzero((s >= least[:, None]).any(axis=1)).tolist():
            row = int(rows[lo + r])
            hit = np.flatnonzero(s[r] >= least[r])
            for c in hit[np.argsort(-s[r][hit], kind="stable")].tolist():
                if s[r][c] < best.least[row]:
                    break
                best.add(row, int(s[r][c]), self.ids[first + c])


class Cells:
    """Centres of the upper levels, the leaves of a cover tree over a sample."""

    def __init__(self, sample: np.ndarray, wanted: int):
        tree = CoverTree(sample, max(1, len(sample) // wanted))
        self.centres = sample[[tree.centre[i] for i in tree.leaves()]]

    def of(self, x: np.ndarray) -> np.ndarray:
        half = (self.centres * self.centres).sum(axis=1) / 2
        return np.concatenate([np.zeros(0, np.int64)] + [
            (half - x[i:i + 4096] @ self.centres.T).argmin(axis=1) for i in range(0, len(x), 4096)])


def integer_vectors(embeddings: DataFrame, scale: int) -> DataFrame:
    """vec_id and vec (longs) of the rows that take part."""
    ship(embeddings.sparkSession)
    scaled = F.transform(F.col("embedding").cast("array<double>"), lambda x: F.lit(float(scale)) * x)
    ok = F.forall("scaled", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float(EXACT)))
    return (embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), scaled.alias("scaled"))
            .where(F.col("vec_id").isNotNull() & F.col("scaled").isNotNull()).where(ok)
            .select("vec_id", F.transform("scaled", lambda x: F.floor(x)).alias("vec")))


def by_length(col: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, their vectors as a matrix) for each length in a column of vectors."""
    sizes = np.asarray(col.value_lengths())
    for n in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == n)
        yield rows, np.asarray(col.take(pa.array(rows)).flatten(), np.int64).reshape(len(rows), n)


def ragged(parts: list, kind: pa.DataType) -> pa.ListArray:
    off = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    flat = np.concatenate([np.asarray(p, np.int64) for p in parts]) if parts else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(off), pa.array(flat, kind))


#: kind 0: an entry (its ids, its vector); kind 1: a block of queries (their ids,
#: their vectors end to end, and the scores that k rows already reach).
ROW = ("size int, cell int, shard int, kind int, ids array<long>, vec array<long>, "
       "high array<long>, low array<long>, reached array<boolean>")


def rows_out(size, cell, shard, kind, ids, vecs, known) -> pa.RecordBatch:
    """``known``: a list of scores (None: not known) for each row."""
    long = pa.int64()
    whole = [[0 if s is None else s for s in k] for k in known]
    return pa.RecordBatch.from_arrays(
        [pa.array(np.asarray(size, np.int32)), pa.array(np.asarray(cell, np.int32)),
         pa.array(np.asarray(shard, np.int32)), pa.array(np.full(len(ids), kind, np.int32)),
         ragged(ids, long), ragged(vecs, long),
         ragged([[s >> LOW_BITS for s in k] for k in whole], long),
         ragged([[s & ((1 << LOW_BITS) - 1) for s in k] for k in whole], long),
         pa.array([[s is not None for s in k] for k in known], pa.list_(pa.bool_()))],
        names=["size", "cell", "shard", "kind", "ids", "vec", "high", "low", "reached"])


def known_of(b: pa.RecordBatch, i: int) -> list[int | None]:
    high, low, ok = (b.column(c)[i].as_py() for c in (6, 7, 8))
    return [(h << LOW_BITS) + w if k else None for h, w, k in zip(high, low, ok)]


def search(embeddings: DataFrame, is_query, k: int = 5, scale: int = 256, sample_rows: int = 20_000,
           cell_rows: int = 16_384, block_rows: int = 512, leaf: int = 128, seed: int = 11) -> DataFrame:
    """query_id, rank, vec_id, score: the k highest integer inner products of every
    row for which ``is_query`` (a column over vec_id) holds, among all other rows."""
    spark = embeddings.sparkSession
    folder = job_dir(spark, "cover-topk")
    rows = integer_vectors(embeddings, scale)
    n = rows.count()
    share = min(1.0, 0.8 * sample_rows / max(1, n))
    # at most sample_rows vectors come to the driver
    sample = (rows.where(F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.lit(1 << 20)) < share * (1 << 20))
              .select("vec").distinct().limit(sample_rows).toArrow())
    vecs = pa.concat_arrays([pa.array([], pa.list_(pa.int64())), *(
        c.cast(pa.list_(pa.int64())) for c in sample.column("vec").chunks)])
    wanted = max(1, -(-n // cell_rows))
    cells = {x.shape[1]: Cells(x.astype(float), min(wanted, max(1, len(x) // 16))) for _, x in by_length(vecs)}

    def place(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(cell, distance to its centre); a length outside the sample has one
        cell around zero."""
        c, x = cells.get(x.shape[1]), x.astype(float)
        if c is None:
            return np.zeros(len(x), np.int64), np.sqrt((x * x).sum(axis=1))
        cell = c.of(x)
        d = x - c.centres[cell]
        return cell, np.sqrt((d * d).sum(axis=1))

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Equal vectors of a task's stretch of rows as one entry."""
        held: dict[int, dict[bytes, list[int]]] = {}
        count = 0

        def flush():
            for size, own in held.items():
                x = np.frombuffer(b"".join(own), np.int64).reshape(len(own), size)
                cell, dist = place(x)
                shard = np.array([zlib.crc32(key) for key in own], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(own), size, np.int32)), pa.array(cell.astype(np.int32)), pa.array(shard),
                     ragged(list(own.values()), pa.int64()), ragged(list(x), pa.int64()), pa.array(dist)],
                    names=["size", "cell", "hash", "ids", "vec", "dist"])
            held.clear()

        for b in batches:
            ids = np.asarray(b.column(0))
            for at, x in by_length(b.column(1)):
                own = held.setdefault(x.shape[1], {})
                for i, v in zip(ids[at].tolist(), x):
                    key = v.tobytes()
                    has = own.get(key)
                    if has is None:
                        own[key] = [i]
                        count += 1
                    elif i not in has:
                        has.append(i)
                        if len(has) > k + 1:
                            has.remove(max(has))
            if count >= 20_000:
                yield from flush()
                count = 0
        yield from flush()

    index = written(rows.mapInArrow(entries, "size int, cell int, hash long, ids array<long>, vec array<long>, "
                                             "dist double"), folder, "index")
    # a row a cell; cells are bounded by the sample
    sums = index.groupBy("size", "cell").agg(F.count("*").alias("n"), F.max("dist").alias("radius")).collect()
    shards = {(r["size"], r["cell"]): max(1, -(-r["n"] // cell_rows)) for r in sums}
    reach: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
    for size in {r["size"] for r in sums}:
        own = sorted((r["cell"], r["radius"]) for r in sums if r["size"] == size)
        number = np.array([c for c, _ in own])
        centre = cells[size].centres[number] if size in cells else np.zeros((1, size))
        reach[size] = number, centre, np.array([r for _, r in own]) * (1 + 1e-9)

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            size, cell, hashed = (np.asarray(b.column(c)) for c in range(3))
            many = np.array([shards[s, c] for s, c in zip(size.tolist(), cell.tolist())], np.int64)
            none = pa.array([[]] * b.num_rows, pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array((hashed % many).astype(np.int32)),
                 pa.array(np.zeros(b.num_rows, np.int32)), b.column(3), b.column(4), none, none,
                 pa.array([[]] * b.num_rows, pa.list_(pa.bool_()))],
                names=["size", "cell", "shard", "kind", "ids", "vec", "high", "low", "reached"])

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at, x in by_length(b.column(1)):
                cell, _ = place(x)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(x), x.shape[1], np.int32)), pa.array(cell.astype(np.int32)),
                     b.column(0).take(pa.array(at)), b.column(1).take(pa.array(at))],
                    names=["size", "cell", "vec_id", "vec"])

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Queries, sorted by cell, as blocks for a shard of their best cell."""
        for b in batches:
            size, cell = np.asarray(b.column(0)), np.asarray(b.column(1))
            cuts = np.flatnonzero(np.diff(size) | np.diff(cell)) + 1
            for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), b.num_rows]):
                for at in range(lo, hi, block_rows):
                    part = b.slice(at, min(block_rows, hi - at))
                    ((_, x),) = by_length(part.column(3))
                    ids = part.column(2).to_pylist()
                    number, centre, _ = reach[x.shape[1]]
                    best = int(number[(centre @ x.mean(axis=0)).argmax()])
                    shard = zlib.crc32(x.tobytes()) % shards[x.shape[1], best]
                    yield rows_out([x.shape[1]], [best], [shard], 1, [ids], [x.ravel()], [[None] * len(ids)])

    def answer(home: bool):
        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            """Rows of a shard come together: its entries, then the blocks.  At home
            a block also goes on, with the k-th scores found, in place of a score."""
            here, ids, parts, shard = None, [], [], None
            for b in batches:
                key = [np.asarray(b.column(c)) for c in range(4)]
                cuts = np.flatnonzero(np.any([np.diff(c) != 0 for c in key], axis=0)) + 1
                for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), b.num_rows]):
                    part = b.slice(lo, hi - lo)
                    if here != tuple(int(c[lo]) for c in key[:3]):
                        here, ids, parts, shard = tuple(int(c[lo]) for c in key[:3]), [], [], None
                    if key[3][lo] == 0:
                        ids += part.column(4).to_pylist()
                        parts += [x for _, x in by_length(part.column(5))]
                        continue
                    if shard is None:
                        merged: dict[bytes, list[int]] = {}
                        x = np.concatenate(parts) if parts else np.zeros((0, here[0]), np.int64)
                        for own, v in zip(ids, x):
                            merged.setdefault(v.tobytes(), []).extend(own)
                        x = np.frombuffer(b"".join(merged), np.int64).reshape(len(merged), here[0])
                        shard = DataShard([sorted(set(v))[:k + 1] for v in merged.values()], x, leaf)
                        ids, parts = [], []
                    for i in range(part.num_rows):
                        own = part.column(4)[i].as_py()
                        q = np.asarray(part.column(5)[i].values, np.int64).reshape(len(own), here[0])
                        best = Best(own, known_of(part, i), k)
                        if len(shard.x):
                            shard.search(q, best, leaf // 4)
                        out = [(o, j, -s) for o, top in zip(own, best.top) for s, j in top]
                        yield found(out)
                        if home:
                            yield carried(here, own, q, best.worst())
            release()
        return work

    def found(out: list[tuple[int, int, int]]) -> pa.RecordBatch:
        long = pa.int64()
        return pa.RecordBatch.from_arrays(
            [pa.array([o for o, _, _ in out], long), pa.array([j for _, j, _ in out], long),
             pa.array([s >> LOW_BITS for _, _, s in out], long),
             pa.array([s & ((1 << LOW_BITS) - 1) for _, _, s in out], long),
             *[pa.nulls(len(out), f) for f in (pa.int32(), pa.int32(), pa.int32(), *[pa.list_(long)] * 4, pa.list_(pa.bool_()))]],
            names=NAMES)

    def carried(here, own, q, worst) -> pa.RecordBatch:
        b = rows_out([here[0]], [here[1]], [here[2]], 1, [own], [q.ravel()], [worst])
        return pa.RecordBatch.from_arrays(
            [*[pa.nulls(1, pa.int64())] * 4, b.column(0), b.column(1), b.column(2), *[b.column(c) for c in (4, 5, 6, 7)],
             b.column(8)], names=NAMES)

    NAMES = ["query_id", "vec_id", "s_high", "s_low", "size", "cell", "shard", "ids", "vec", "high", "low", "reached"]
    ANSWER = ("query_id long, vec_id long, s_high long, s_low long, size int, cell int, shard int, ids array<long>, "
              "vec array<long>, high array<long>, low array<long>, reached array<boolean>")

    def away(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A block for every shard, but the one it has asked, of each cell that its
        covering radius and worst k-th score leave open."""
        for b in batches:
            b = b.select(["size", "cell", "shard", "query_id", "ids", "vec", "high", "low", "reached"])
            for i in range(b.num_rows):
                size, cell, asked = (b.column(c)[i].as_py() for c in range(3))
                ids = b.column(4)[i].as_py()
                q = np.asarray(b.column(5)[i].values, np.int64).reshape(len(ids), size)
                known = known_of(b, i)
                least = min(-np.inf if s is None else _down(s) for s in known)
                number, centre, radius = reach[size]
                mid = q.mean(axis=0)
                d = q - mid
                r = float(np.sqrt((d * d).sum(axis=1)).max()) * (1 + 1e-9)
                norm = np.sqrt((centre * centre).sum(axis=1))
                most = (float(np.sqrt(mid @ mid)) + r) * (norm + radius)
                bound = centre @ mid + r * norm + radius * (float(np.sqrt(mid @ mid)) + r) + 1e-9 * most + 0.5
                for c in number[bound >= least].tolist():
                    for s in range(shards[size, c]):
                        if (c, s) != (cell, asked):
                            yield rows_out([size], [c], [s], 1, [ids], [q.ravel()], [known])

    def asked(queries: DataFrame, home: bool) -> DataFrame:
        data = index.select("size", "cell", "hash", "ids", "vec").mapInArrow(dealt, ROW)
        return (data.unionByName(queries).repartition("size", "cell", "shard")
                .sortWithinPartitions("size", "cell", "shard", "kind").mapInArrow(answer(home), ANSWER))

    ask = (rows.where(is_query).groupBy("vec_id").agg(F.min("vec").alias("vec"))
           .mapInArrow(placed, "size int, cell int, vec_id long, vec array<long>"))
    # queries of a cell together, a cell of many in several tasks
    salt = F.pmod(F.xxhash64("vec_id"), F.lit(max(1, -(-n // (64 * cell_rows)))))
    ask = (ask.withColumn("salt", salt).repartition("size", "cell", "salt")
           .sortWithinPartitions("size", "cell", "vec_id").drop("salt"))
    home = written(asked(ask.mapInArrow(blocks, ROW), True), folder, "home")
    again = asked(home.where("query_id is null").mapInArrow(away, ROW), False)
    scores = (home.where("query_id is not null").unionByName(again)
              .groupBy("query_id", "vec_id").agg(F.max(F.struct("s_high", "s_low")).alias("s")))
    best = Window.partitionBy("query_id").orderBy(F.desc("s"), "vec_id")
    top = 1 << (63 - LOW_BITS)
    score = (F.when(F.col("s.s_high") >= top, F.lit((1 << 63) - 1))
             .when(F.col("s.s_high") < -top, F.lit(-(1 << 63)))
             .otherwise(F.col("s.s_high") * F.lit(1 << LOW_BITS) + F.col("s.s_low")))
    return (scores.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", score.alias("score")))
