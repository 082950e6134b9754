"""Operator 12: periodic runs of words, found by tiles of every period octave.

A run is a longest stretch of consecutive words with smallest period q and at
least max(``least``, ``times`` * q) words.  Periods are taken by octaves [P, 2P),
P = 1, 2, 4 ..  In an octave a document has boundaries at the multiples of P; a
run of period p holds whole blocks of P words after a boundary b that are equal p
words on.  Those pairs (b, p) are told by hashes of P words, doubled from octave
to octave, so that the work of an octave is linear.  Neighbouring blocks of one
period are joined, compared word by word, and the ends are reached by the Z-function of the words after the first
or last boundary and by that of the words before it, reversed.  The interval
[lo, hi) of positions that equal the word p on is a fragment.

Tiles: a document of at most ``tile_words`` words is one tile, and so solved where
it is read; a longer one is exploded into overlapping tiles, of ``tile_words`` for
the octaves up to a ``REACH``-th of it, and of REACH periods for each octave above,
which are dealt to all tasks.  Tiles see P words before their own and 4P after them.
Fragments that are long enough, or reach the tile's end and may go on, are shuffled
by (document, period), and those that overlap or touch are one interval.  A period with a stretch inside one of a
divisor is not smallest and goes.

A boundary whose blocks of all periods of the octave lie inside a stretch of a
known shorter period is left out: by the theorem of Fine and Wilf every period
there is a multiple of that one.  So repetitive texts don't cost more.

A null text has no words.  A document without runs keeps all its words.  Repeated
rows give a row each; rows with one doc_id and unlike texts are told apart by
their texts; a null doc_id is a document like others.  A table without rows gives
none.  ``times`` is at least 3, so that a run holds a whole block.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsekit.session import ship
from pulsekit.llm.common import job_dir, pieces, release, splitmix, written

#: A tile owns boundaries over this many periods of its largest octave, at least.
REACH = 16


def z_function(s: list) -> list[int]:
    """For each place the length of the longest common prefix with the whole."""
    z = [0] * len(s)
    left = right = 0
    for i in range(1, len(s)):
        k = min(right - i, z[i - left]) if i < right else 0
        while i + k < len(s) and s[k] == s[i + k]:
            k += 1
        if i + k > right:
            left, right = i, i + k
        z[i] = k
    return z


def forward(w: np.ndarray, b: int, P: int) -> list[int]:
    """For p in [P, 2P): how many words from b on equal the word p on, to 2P."""
    z = z_function(w[b:b + 4 * P].tolist())[P:2 * P]
    return [min(k, 2 * P) for k in z] + [0] * (P - len(z))


def backward(w: np.ndarray, b: int, P: int) -> list[int]:
    """For p in [P, 2P): how many words before b equal the word p on, to P."""
    before = w[max(0, b - P):b][::-1].tolist()
    beyond = 2 * P - (min(len(w), b + 2 * P) - b)          # words that the array lacks
    z = z_function(before + [None] + w[max(0, b - P):b + 2 * P][::-1].tolist())
    at = len(before) + 1 - beyond
    return [z[at + 2 * P - p] if 2 * P - p >= beyond else 0 for p in range(P, 2 * P)]


def joined(period, lo, hi) -> list[tuple[int, int, int]]:
    """Overlapping or touching intervals of a period as one."""
    out: list[tuple[int, int, int]] = []
    for p, a, b in sorted(zip(period, lo, hi)):
        if out and out[-1][0] == p and a <= out[-1][2]:
            out[-1] = (p, out[-1][1], max(b, out[-1][2]))
        else:
            out.append((p, a, b))
    return out


def doubled(h: np.ndarray, P: int) -> np.ndarray:
    """Hashes of 2P words from those of P; places without as many words hold 0."""
    out = np.zeros(len(h), np.uint64)
    if len(h) > P:
        out[:-P] = splitmix(h[:-P] * np.uint64(0x9E3779B97F4A7C15) + h[P:])
    return out


def octave(w: np.ndarray, h: np.ndarray, P: int, known: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """Intervals (p, lo, hi) of periods in [P, 2P); ``h``: hashes of P words;
    ``known``: stretches of shorter periods."""
    rows = -(-len(w) // P)
    cells = np.concatenate([h, np.zeros((rows + 1) * P - len(h), np.uint64)]).reshape(rows + 1, P)
    same = cells[1:] == cells[:-1, :1]
    same[np.arange(rows) * P + 2 * P > len(w)] = False
    hit = np.flatnonzero(same.any(axis=1))
    if len(hit) and known:
        start, end = np.array(sorted(known)).T
        end = np.maximum.accumulate(end)
        b = hit * P
        at = np.searchsorted(start, b, side="right") - 1
        hit = hit[(at < 0) | (end[at] < np.minimum(b + 3 * P - 1, len(w)))]
    if not len(hit):
        return []
    k, j = np.nonzero(same[hit])
    # words are compared, or where many periods start at a boundary, its Z-function
    direct = len(k) <= 64 * len(hit)
    k = hit[k]
    order = np.lexsort((k, j))
    k, j = k[order], j[order]
    cut = np.flatnonzero((np.diff(j) != 0) | (np.diff(k) != 1)) + 1
    after: dict[int, list[int]] = {}
    before: dict[int, list[int]] = {}
    out = []

    def on(b: int) -> list[int]:
        if b not in after:
            after[b] = forward(w, b, P)
        return after[b]

    def ends(first: int, last: int, j: int) -> None:
        if first not in before:
            before[first] = backward(w, first, P)
        if on(last)[j] >= P:                 # else the hashes were equal by chance
            out.append((P + j, first - before[first][j], last + on(last)[j]))

    for a, z in zip([0, *cut.tolist()], [*cut.tolist(), len(k)]):
        c, first, last = int(j[a]), int(k[a]) * P, int(k[z - 1]) * P
        p = P + c
        if np.array_equal(w[first:last + P], w[first + p:last + P + p]) if direct else all(
                on(b)[c] >= P for b in range(first, last + 1, P)):
            ends(first, last, c)
        else:
            for b in range(first, last + 1, P):
                ends(b, b, c)
    return joined(*zip(*out)) if out else []


def long_enough(p: int, lo: int, hi: int, least: int, times: int) -> bool:
    return hi - lo + p >= max(least, times * p)


def solve_whole(parts: list[np.ndarray], least: int, times: int) -> dict[int, list[tuple[int, int, int]]]:
    """Intervals of whole documents, solved together; each holds codes >= 0."""
    found: dict[int, list[tuple[int, int, int]]] = {}
    live = [i for i, w in enumerate(parts) if len(w) >= least]
    known: dict[int, list[tuple[int, int]]] = {}
    w = h = None
    P = 1
    while live:
        keep = [i for i in live if len(parts[i]) >= times * P]
        if not keep:
            break
        if w is None or 4 * sum(len(parts[i]) for i in keep) < 3 * len(w):
            # a code of its own parts a document from the next
            size = np.array([len(parts[i]) + 1 for i in live])
            if w is None:
                w = np.concatenate([np.append(parts[i], -1 - i) for i in live])
                h = splitmix(w.astype(np.uint64))
            chosen = np.repeat(np.isin(live, keep), size)
            w, h, live = w[chosen], h[chosen], keep
        starts = np.concatenate([[0], np.cumsum([len(parts[i]) + 1 for i in live])])
        place = {i: int(s) for i, s in zip(live, starts.tolist())}
        stretches = [(place[i] + a, place[i] + b) for i in live for a, b in known.get(i, ())]
        for p, lo, hi in octave(w, h, P, stretches):
            n = int(np.searchsorted(starts, lo, side="right")) - 1
            i, at = live[n], int(starts[n])
            known.setdefault(i, []).append((lo - at, hi - at + p))
            if long_enough(p, lo, hi, least, times):
                found.setdefault(i, []).append((p, lo - at, hi - at))
        h = doubled(h, P)
        P *= 2
    return found


def tiles(n: int, tile_words: int, times: int) -> Iterator[tuple[int, int, int, int]]:
    """(first octave, last octave, first word, end) of a long document's tiles."""
    top = max(1, tile_words // REACH)
    top = 1 << (top.bit_length() - 1)
    first = 1
    while first == 1 or times * first <= n:
        last = top if first == 1 else first
        for lo in range(0, n, REACH * last):
            yield first, last, max(0, lo - last), min(lo + (REACH + 4) * last, n)
        first = 2 * last


def solve_tile(w: np.ndarray, begin: int, first: int, last: int, n: int, least: int, times: int
               ) -> list[tuple[int, int, int]]:
    """Intervals of the octaves from ``first`` to ``last`` in the words ``w`` from
    ``begin`` on: those that are long enough, or reach an end and may go on."""
    out, known = [], []
    h = splitmix(w.astype(np.uint64))
    P = 1
    while P <= last:
        for p, a, b in octave(w, h, P, known):
            known.append((a, b + p))
            open_end = a == 0 and begin > 0 or b + p >= len(w) and begin + len(w) < n
            if P >= first and (open_end or long_enough(p, a, b, least, times)):
                out.append((p, a + begin, b + begin))
        h = doubled(h, P)
        P *= 2
    return out


def smallest_only(runs: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(start, length, period) without those inside a stretch of a divisor of their
    period, by start, then period."""
    by_period: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    kept = []
    for p in sorted({r[2] for r in runs}):
        own = np.array(sorted((s, s + n) for s, n, q in runs if q == p), np.int64)
        good = np.ones(len(own), bool)
        for d, (start, end) in by_period.items():
            if p % d == 0:
                at = np.searchsorted(start, own[:, 0], side="right") - 1
                good &= (at < 0) | (end[at] < own[:, 1])
        if good.any():
            own = own[good]
            by_period[p] = own[:, 0], own[:, 1]
            kept += [(s, e - s, p) for s, e in own.tolist()]
    return sorted(kept, key=lambda r: (r[0], r[2]))


def without_repeats(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that no run holds after its first period, one blank between."""
    if not runs:
        return b" ".join(words)
    step = np.zeros(len(words) + 1, np.int64)
    for s, n, p in runs:
        step[s + p] += 1
        step[s + n] -= 1
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(step[:-1]) == 0).tolist()])


def planted(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The query's own repetition: of a document whose crc32(doc_id) ends in 0 the
    words from a on repeat with period p.  A null doc_id has no decimal form."""
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    unit = words[a:a + p]
    return words[:a] + (unit * (-(-(n - a) // p)))[:n - a]


ROW = ("doc_id long, n_words long, text binary, key binary, part array<struct<period:long,lo:long,hi:long>>, "
       "first int, last int, begin long, tile binary")
NAMES = ["doc_id", "n_words", "text", "key", "part", "first", "last", "begin", "tile"]
PART = pa.list_(pa.struct([("period", pa.int64()), ("lo", pa.int64()), ("hi", pa.int64())]))
SPLIT = {"period": 0, "lo": 1, "hi": 2}


def spans(found: list[tuple[int, int, int]] | None):
    return None if found is None else [dict(zip(SPLIT, f)) for f in found]


def runs(docs: DataFrame, least: int = 6, times: int = 4, tile_words: int = 16_384,
         edit: Callable[[list[bytes], int | None], list[bytes]] | None = None) -> DataFrame:
    """doc_id, n_words, runs (array of start, length, period by start, then period)
    and ``collapsed``, the text without the words that repeat a run's first period,
    words one blank apart.  ``edit`` changes a document's words before."""
    if times < 3:
        raise ValueError("times is at least 3")
    spark = docs.sparkSession
    ship(spark)
    folder = job_dir(spark, "word-runs")

    def words_of(text: bytes | None, doc_id: int | None) -> list[bytes]:
        words = (text or b"").split()        # at \x20 and \x09 to \x0D, as bytes are split
        return edit(words, doc_id) if edit else words

    def scan(plain: bool):
        """Rows of documents without a fragment (``plain``), with the text collapsed;
        or of the others: the text and its fragments, or the tiles of a long one."""
        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for b in pieces(batch, 2_000_000):
                    ids, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
                    yield from solved(ids, texts)
            release()

        def solved(ids, texts):
            words = [words_of(t, i) for t, i in zip(texts, ids)]
            code: dict[bytes, int] = {}
            short = [i for i, w in enumerate(words) if len(w) <= tile_words]
            found = solve_whole([np.array([code.setdefault(x, len(code)) for x in words[i]], np.int64) for i in short],
                                least, times)
            found = {short[i]: f for i, f in found.items()}
            out = []
            for i, w in enumerate(words):
                none = len(w) <= tile_words and i not in found
                if none and plain:
                    out.append([ids[i], len(w), b" ".join(w)] + [None] * 6)
                if none or plain:
                    continue
                key = hashlib.blake2b(f"{ids[i]}:".encode() + (texts[i] or b""), digest_size=16).digest()
                out.append([ids[i], len(w), texts[i], key, spans(found.get(i))] + [None] * 4)
                if len(w) > tile_words:
                    own = np.array([code.setdefault(x, len(code)) for x in w], np.int64)
                    for first, last, begin, end in tiles(len(w), tile_words, times):
                        out.append([None, len(w), None, key, None, first, last, begin, own[begin:end].astype("<i4").tobytes()])
                        if len(out) >= 64:
                            yield batch_of(out)
                            out = []
            if out:
                yield batch_of(out)
        return work

    def batch_of(out) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), PART, pa.int32(), pa.int32(), pa.int64(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], t) for c, t in enumerate(kinds)], names=NAMES)

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                key, n, first, last, begin, tile = (b.column(c)[i].as_py() for c in range(6))
                got = solve_tile(np.frombuffer(tile, "<i4").astype(np.int64), begin, first, last, n, least, times)
                if got:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([key] * len(got), pa.binary()), *[pa.array([g[c] for g in got], pa.int64()) for c in range(3)]],
                        names=["key", "period", "lo", "hi"])

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in pieces(batch, 2_000_000):
                ids, texts, n = (b.column(c).to_pylist() for c in range(3))
                every, out = [], []
                for doc_id, text, found in zip(ids, texts, b.column(3).to_pylist()):
                    every.append(smallest_only([(f["start"], f["length"], f["period"]) for f in found or ()]))
                    out.append(without_repeats(words_of(text, doc_id), every[-1]))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array(n, pa.int64()),
                     pa.array([[dict(zip(("start", "length", "period"), r)) for r in rs] for rs in every], RUNS),
                     pa.array(out, pa.binary())], names=["doc_id", "n_words", "runs", "collapsed"])
        release()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))
    marked = written(rows.mapInArrow(scan(False), ROW), folder, "marked")
    tiled = (marked.where("tile is not null").select("key", "n_words", "first", "last", "begin", "tile")
             .repartition("key", "first", "begin").mapInArrow(solve, "key binary, period long, lo long, hi long"))
    parts = marked.where("part is not null").select("key", F.inline("part")).unionByName(tiled).distinct()
    # stitch: an interval starts where no earlier one reaches
    by_lo = Window.partitionBy("key", "period").orderBy("lo", "hi")
    earlier = F.max("hi").over(by_lo.rowsBetween(Window.unboundedPreceding, -1))
    whole = (parts.withColumn("starts", (earlier.isNull() | (F.col("lo") > earlier)).cast("long"))
             .withColumn("number", F.sum("starts").over(by_lo.rowsBetween(Window.unboundedPreceding, 0)))
             .groupBy("key", "period", "number").agg(F.min("lo").alias("start"), F.max("hi").alias("hi"))
             .withColumn("length", F.col("hi") - F.col("start") + F.col("period"))
             .where(F.col("length") >= F.greatest(F.lit(least), F.lit(times) * F.col("period"))))
    of_doc = whole.groupBy("key").agg(F.collect_list(F.struct("start", "length", "period")).alias("runs"))
    repeated = (marked.where("tile is null").select("key", "doc_id", "text", "n_words").join(of_doc, "key", "left")
                .select("doc_id", "text", "n_words", "runs")
                .mapInArrow(finish, "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, "
                                    "collapsed binary"))
    plain = rows.mapInArrow(scan(True), ROW).select(
        "doc_id", "n_words", F.array().cast("array<struct<start:long,length:long,period:long>>").alias("runs"),
        F.col("text").alias("collapsed"))
    return repeated.unionByName(plain).withColumn("collapsed", F.col("collapsed").cast("string"))


RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def digests(found: DataFrame) -> DataFrame:
    """doc_id, n_runs, the run of the greatest length / period, and checksums."""
    def better(a, b):
        """The run of a greater exact length / period; runs come by start, then
        period, so that the first of equal ones stays."""
        return F.when(a.isNull() | (b["length"] * a["period"] > a["length"] * b["period"]), b).otherwise(a)

    none = F.lit(None).cast("struct<start:long,length:long,period:long>")
    line = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","),
                                                  r["period"].cast("string"), F.lit("\n")))
    return (found.withColumn("best", F.aggregate("runs", none, better))
            .select("doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"),
                    F.col("best.length").alias("length"), F.col("best.period").alias("period"),
                    F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
                    F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"),
                    F.sha2("collapsed", 256).alias("collapsed_sha256")))
