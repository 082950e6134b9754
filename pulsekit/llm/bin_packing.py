"""Operator 9: best-fit packing of documents into fixed-size sequences.

Only lengths matter to a packing, and there are at most ``capacity`` of them:
Spark counts the pieces of each length, the driver packs that histogram (at
most ``capacity`` numbers, whatever the table's size), and every piece finds
its place by its rank among the pieces of its length.

The packing is bin completion: the largest length left opens a sequence, the
undominated fillings of the rest are enumerated, least waste first, and a
filling is applied as often as the counts allow.  Best-fit decreasing is the
first incumbent; the search goes on, and back to other fillings, while the
waste so far leaves room below the incumbent (the bound: sequences used plus
the remaining ids over the capacity) and nodes are left.

Empty texts hold only the end id.  Null doc_id, repeated rows and equal lengths
are pieces like any others; a table without rows gives none.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsekit.llm.common import id_and_text, job_dir, pieces, release, written
from pulsekit.llm.units import encoder

PIECES = ("doc_id long, piece int, start long, length long, ids_crc32 long, "
          "block long, place long")


def cut(docs: DataFrame, tokenizer: str, end_id: int, capacity: int) -> DataFrame:
    """Token pieces of every text: whole documents up to ``capacity`` ids;
    longer ones in pieces of ``capacity``, the first holding what is over.
    ``block`` and ``place``: the run of rows a piece was made in, and its rank
    there among the pieces of its length."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        enc = encoder(tokenizer)
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            for b in pieces(batch, 2_000_000):
                ids, lens = enc.encode(b.column(1))
                ids = np.insert(ids, np.cumsum(lens), end_id)
                lens = lens + 1
                count = -(-lens // capacity)
                row = np.repeat(np.arange(len(lens)), count)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
                over = lens - (count - 1) * capacity
                start = np.where(piece == 0, 0, over[row] + (piece - 1) * capacity)
                length = np.where(piece == 0, over[row], capacity)
                raw = memoryview(ids.astype("<u4").tobytes())
                at = 4 * ((np.cumsum(lens) - lens)[row] + start)
                crc = [zlib.crc32(raw[a:a + 4 * n]) for a, n in zip(at.tolist(), length.tolist())]
                order = np.argsort(length, kind="stable")
                same = np.searchsorted(length[order], length[order])
                place = np.empty(len(row), np.int64)
                place[order] = np.arange(len(row)) - same
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(start),
                     pa.array(length), pa.array(crc, pa.int64()),
                     pa.array(np.full(len(row), block)), pa.array(place)],
                    names=["doc_id", "piece", "start", "length", "ids_crc32", "block", "place"])
                block += 1
        release()

    return id_and_text(docs).mapInArrow(work, PIECES)


def fillings(lengths: list[int], counts: dict[int, int], room: int, most: int) -> list[list[int]]:
    """Undominated fillings of ``room`` with the lengths at hand (``lengths``
    ascending, those with a count), least waste first, then fewest pieces, at
    most ``most``.  A filling is dominated when one with fewer pieces leaves no
    more waste; of the fillings of one sum, that with the largest piece stays."""
    best: dict[int, list[int]] = {}
    budget = [2000]

    def grow(room_left: int, below: int, held: list[int]) -> None:
        """``held``: lengths taken, in runs; the next run is of one below."""
        budget[0] -= 1
        i = bisect_right(lengths, min(room_left, below - 1)) - 1
        if i < 0 or budget[0] < 0:
            s = room - room_left
            if s not in best or len(held) < len(best[s]):
                best[s] = held
            return
        for i in range(i, max(-1, i - 24), -1):
            v = lengths[i]
            most_copies = min(counts[v], room_left // v)
            for copies in range(most_copies, max(0, most_copies - 3), -1):
                if room in best and len(best[room]) <= len(held) + 1 or budget[0] <= 0:
                    return
                grow(room_left - v * copies, v, held + [v] * copies)

    grow(room, room + 1, [])
    out: list[list[int]] = []
    for s in sorted(best, reverse=True):
        if not out or len(best[s]) < len(out[-1]):
            out.append(best[s])
    return out[:most]


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """Sequences any packing needs: ids over capacity, or those that pieces
    above half, and what does not fit beside them, need."""
    total = -(-sum(n * c for n, c in counts.items()) // capacity)
    for k in sorted({n for n in counts if 2 * n <= capacity} | {0}):
        large = sum(c for n, c in counts.items() if n > capacity - k)
        mid = [(n, c) for n, c in counts.items() if capacity - k >= n and 2 * n > capacity]
        small = sum(n * c for n, c in counts.items() if k <= n and 2 * n <= capacity)
        free = sum(c * (capacity - n) for n, c in mid)
        need = large + sum(c for _, c in mid) + max(0, -(-(small - free) // capacity))
        total = max(total, need)
    return total


def best_fit(histogram: dict[int, int], capacity: int) -> list[tuple[list[int], int]]:
    """Best-fit decreasing over counted lengths: the first incumbent."""
    rooms: list[int] = []                         # ascending; those with an entry
    groups: dict[int, list[tuple[list[int], int]]] = {}

    def add(room: int, pattern: list[int], times: int) -> None:
        if room not in groups:
            groups[room] = []
            rooms.insert(bisect_right(rooms, room), room)
        groups[room].append((pattern, times))

    for n in sorted(histogram, reverse=True):
        c = histogram[n]
        while c:
            i = bisect_right(rooms, n - 1)
            if i == len(rooms):
                q = capacity // n
                if c // q:
                    add(capacity - q * n, [n] * q, c // q)
                if c % q:
                    add(capacity - c % q * n, [n] * (c % q), 1)
                break
            room = rooms[i]
            pattern, times = groups[room].pop()
            if not groups[room]:
                del groups[room]
                rooms.pop(i)
            q = min(room // n, c)                 # the tightest sequence stays the tightest
            k = min(times, c // q)
            if times > k:
                add(room, pattern, times - k)
            add(room - q * n, pattern + [n] * q, k)
            c -= q * k
    return [x for g in groups.values() for x in g]


def complete_bins(histogram: dict[int, int], capacity: int, nodes: int = 10_000,
                  branches: int = 3) -> list[tuple[list[int], int]]:
    """(lengths of a sequence, how many sequences are filled so), as few
    sequences as found within ``nodes`` nodes of the search."""
    histogram = {int(n): int(c) for n, c in histogram.items() if c > 0}
    if any(n > capacity or n <= 0 for n in histogram):
        raise ValueError("a length outside 1..capacity")
    floor = lower_bound(histogram, capacity)
    best = best_fit(histogram, capacity)
    best_n = sum(times for _, times in best)
    left = dict(histogram)
    lengths = sorted(left)
    total = sum(n * c for n, c in left.items())
    used = 0
    path: list[tuple[list[int], int]] = []
    stack: list[list[list[int]]] = []

    def take(pattern: list[int], sign: int, times: int) -> None:
        nonlocal total, used
        for n in set(pattern):
            before = left[n]
            left[n] -= sign * times * pattern.count(n)
            if left[n] == 0:
                del lengths[bisect_right(lengths, n) - 1]
            elif before == 0:
                lengths.insert(bisect_right(lengths, n), n)
        total -= sign * times * sum(pattern)
        used += sign * times

    def options() -> list[list[int]]:
        top = lengths[-1]
        left[top] -= 1
        if not left[top]:
            lengths.pop()
        found = fillings(lengths, left, capacity - top, branches)
        if not left[top]:
            lengths.append(top)
        left[top] += 1
        return [[top, *f] for f in found] or [[top]]

    while True:
        nodes -= 1
        if not lengths and used < best_n:
            best, best_n = list(path), used
        if lengths and used + -(-total // capacity) < best_n and nodes > 0:
            stack.append(options()[::-1])
        else:
            if best_n <= floor or nodes <= 0:
                break
            while path:
                take(path[-1][0], -1, path[-1][1])
                path.pop()
                if stack and stack[-1]:
                    break
                stack.pop()
            if not stack or not stack[-1]:
                break
        pattern = stack[-1].pop()
        times = min(left[n] // pattern.count(n) for n in set(pattern))
        take(pattern, 1, times)
        path.append((pattern, times))
    return best


def places(plan: list[tuple[list[int], int]]) -> dict[str, np.ndarray]:
    """Where the pieces of each length go, by rank: rows (length, first rank,
    copies in a sequence, first sequence, offset), sorted by the first two."""
    rank: dict[int, int] = {}
    rows, sequence = [], 0
    for pattern, times in plan:
        offset = 0
        for n in sorted(set(pattern), reverse=True):
            copies = pattern.count(n)
            rows.append((n, rank.get(n, 0), copies, sequence, offset))
            rank[n] = rank.get(n, 0) + copies * times
            offset += n * copies
        sequence += times
    a = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return {k: a[:, i].copy() for i, k in enumerate(("length", "rank", "copies", "sequence", "offset"))}


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = 2048,
                   nodes: int = 10_000) -> DataFrame:
    """One row per piece with the sequence and the offset it got."""
    folder = job_dir(docs.sparkSession, "packing")
    made = written(cut(docs, tokenizer, end_id, capacity), folder, "pieces")
    counts = made.groupBy("length", "block").agg(F.count("*").alias("n"))
    # at most ``capacity`` rows come to the driver
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    at = places(complete_bins(histogram, capacity, nodes))
    key = at["length"] * (1 << 44) + at["rank"]

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length, rank = (np.asarray(b.column(i)) for i in (3, 5))
            i = np.searchsorted(key, length * (1 << 44) + rank, side="right") - 1
            q, r = np.divmod(rank - at["rank"][i], at["copies"][i])
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:5], pa.array(at["sequence"][i] + q), pa.array(at["offset"][i] + r * length)],
                names=[*b.schema.names[:5], "sequence_id", "offset"])

    before = Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select("length", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    ranked = made.join(firsts, ["length", "block"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("first") + F.col("place")).alias("rank"))
    return ranked.mapInArrow(put, "doc_id long, piece int, start long, length long, ids_crc32 long, "
                                  "sequence_id long, offset long")
