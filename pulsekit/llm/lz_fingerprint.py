"""Operator 4: Lempel-Ziv phrase fingerprints.

A text is parsed from the left into dictionary phrases: each is the shortest
stretch that is not yet in the dictionary, which it then joins.  The phrases
are hashed and the ``size`` smallest 32-bit hashes are the fingerprint.  Of two
fingerprints, the share of the smallest hashes of their union that both hold
estimates the Jaccard likeness of the phrase sets: texts that a Lempel-Ziv
compressor would shrink together are alike.

``edited_likeness`` also fingerprints each text after its last quarter is
replaced by the beginning of the next document.  Documents go to ranges of
doc_id, and the first document of a range also to the range before it, so each
text moves once and a task needs two texts at a time.

Null texts are empty; two empty texts are alike (1.0), an empty and another are
not (0.0).  Null doc_id come first, and rows of one doc_id are ordered by text;
a single row is its own next document.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsekit.llm.common import id_and_text, splitmix

#: Odd multiplier of the rolling hash, and its inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> list[np.ndarray]:
    """BASE ** i and BASE ** -i for i below n; a worker keeps those of usual
    lengths."""
    have = len(_POWERS[0])
    if have >= n:
        return _POWERS
    made = []
    for b in (BASE, INVERSE):
        p = np.full(max(n, min(2 * have, 1 << 20)), b, np.uint64)
        p[0] = 1
        made.append(np.multiply.accumulate(p))
    if n <= 1 << 22:
        _POWERS[:] = made
    return made


def phrases(text: str, seen: set[str], ends: list[int], start: int) -> None:
    """Parse on from ``start``: new phrases join ``seen``, their ends ``ends``.
    Every prefix of a phrase is a phrase, so the shortest new stretch is found
    from any guess of its length; the last length is the guess."""
    n, s, g = len(text), start, 3
    add, put = seen.add, ends.append
    while s < n:
        e = s + g
        if text[s:e] in seen:
            e += 1
            while e <= n and text[s:e] in seen:
                e += 1
            if e > n:
                return
        else:
            if e > n:
                e = n
            e -= 1
            while e > s and text[s:e] not in seen:
                e -= 1
            e += 1
        add(text[s:e])
        put(e)
        g = e - s
        s = e


def fingerprint(text: str, ends: list[int], size: int) -> np.ndarray:
    """The smallest hashes of the phrases that end at ``ends``."""
    if not ends:
        return np.zeros(0, np.uint32)
    chars = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)[:ends[-1]].astype(np.uint64)
    up, down = powers(len(chars) + 1)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum((chars + np.uint64(1)) * up[:len(chars)])])
    hi = np.array(ends)
    lo = np.concatenate([[0], hi[:-1]])
    h = (total[hi] - total[lo]) * down[lo] + (hi - lo).astype(np.uint64)
    h = (splitmix(h) >> np.uint64(32)).astype(np.uint32)
    if len(h) > 2 * size:
        h = np.partition(h, 2 * size)[:2 * size + 1]
    return np.unique(h)[:size]


def likeness(a: np.ndarray, b: np.ndarray, size: int) -> float:
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    low = np.union1d(a, b)[:size]
    return len(np.intersect1d(low, np.intersect1d(a, b, True), True)) / len(low)


def as_string(f: np.ndarray) -> str:
    return base64.b64encode(f.astype("<u4").tobytes()).decode()


def from_string(s: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(s), "<u4")


class Parsed:
    def __init__(self, doc_id: int | None, text: str, size: int):
        self.doc_id, self.text, self.size = doc_id, text, size
        self.ends: list[int] = []
        self.seen: set[str] = set()
        phrases(text, self.seen, self.ends, 0)
        self.print = fingerprint(text, self.ends, size)

    def edited(self, after: str) -> tuple[str, np.ndarray]:
        """The text with its last quarter replaced by as much of ``after``, and
        its fingerprint; the parse up to the edit is shared."""
        n = len(self.text)
        text = self.text[:n - n // 4] + after[:n // 4]
        ends, seen = self.ends, self.seen
        k = int(np.searchsorted(np.array(ends), n - n // 4, side="right")) if ends else 0
        cuts = [0, *ends]
        for i in range(k, len(ends)):                 # phrases from here on are undone
            seen.discard(text_of(self.text, cuts, i))
        ends = ends[:k]
        phrases(text, seen, ends, ends[-1] if ends else 0)
        return text, fingerprint(text, ends, self.size)


def text_of(text: str, cuts: list[int], i: int) -> str:
    return text[cuts[i]:cuts[i + 1]]


FIELDS = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
          "edited_fingerprint string, near_edited double, near_next double")
#: Stands for a null doc_id in the order of documents.
NULL_ID = -(1 << 63)


def edited_likeness(docs: DataFrame, size: int = 128) -> DataFrame:
    rows = id_and_text(docs).withColumn("key", F.coalesce("doc_id", F.lit(NULL_ID)))
    n_ranges = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # at most n_ranges numbers come to the driver; they are keys of the table
    cuts = rows.agg(F.min("key").alias("lo"), F.percentile_approx(
        "key", [i / n_ranges for i in range(1, n_ranges)], 20 * n_ranges).alias("cuts")).first()
    firsts = np.array(sorted({cuts["lo"], *(cuts["cuts"] or [])} - {None}) or [0], np.int64)

    @F.pandas_udf("int")
    def range_of(key: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(firsts, key, side="right") - 1).astype("int32")

    @F.pandas_udf("int")
    def before(key: pd.Series) -> pd.Series:
        """The range before the one that this key begins, -1 if it begins none."""
        at = np.searchsorted(firsts, key, side="right") - 1
        return pd.Series(np.where(firsts[at] == key, (at - 1) % len(firsts), -1)).astype("int32")

    dealt = (rows.withColumn("own", range_of("key")).withColumn("before", before("key"))
             .withColumn("put", F.explode(F.when(
                 F.col("before") >= 0,
                 F.array(F.struct(F.col("own").alias("range"), F.lit(False).alias("guest")),
                         F.struct(F.col("before").alias("range"), F.lit(True).alias("guest"))))
                 .otherwise(F.array(F.struct(F.col("own").alias("range"), F.lit(False).alias("guest"))))))
             .select("put.range", "put.guest", "doc_id", "text")
             .repartition("range").sortWithinPartitions("range", "guest", "doc_id", "text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[int, Parsed] | None = None
        out: list[tuple] = []

        def close(p: Parsed, after: Parsed) -> tuple:
            next_text, next_print = after.text, after.print
            text, f = p.edited(next_text)
            return (p.doc_id, len(p.text), hashlib.sha256(text.encode()).hexdigest(),
                    as_string(p.print), as_string(f), likeness(p.print, f, size),
                    likeness(p.print, next_print, size))

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            names = [x.split()[0] for x in FIELDS.split(", ")]
            kinds = [pa.int64(), pa.int64(), *[pa.string()] * 3, pa.float64(), pa.float64()]
            return pa.RecordBatch.from_arrays(
                [pa.array(x, k) for x, k in zip(zip(*rows), kinds)], names=names)

        for b in batches:
            for r, guest, doc_id, text in zip(*(c.to_pylist() for c in b.columns)):
                if guest and (held is None or held[0] != r):
                    continue                      # the first guest closed the range
                p = Parsed(doc_id, text, size)
                if held is not None and held[0] == r:
                    out.append(close(held[1], p))
                held = None if guest else (r, p)
                if len(out) >= 500:
                    yield batch_of(out)
                    out = []
        if out:
            yield batch_of(out)

    return dealt.mapInArrow(work, FIELDS)
