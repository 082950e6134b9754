"""Operator 7: n-gram Jaccard join by grouped prefixes.

A document's set holds its distinct word shingles.  Documents with one set are a
class; the classes are the join's rows.  Shingles have one order for all sets,
rare ones first, by counts in a table of ``1 << sketch_bits`` counters: any such
order is right, this one keeps frequent passages out of the prefixes.  Two sets
can only reach the threshold if their prefixes (the first n - ceil(t n) + 1
shingles) meet.  Classes of one size and prefix are a group; prefixes are
compared between groups only.  Pairs of groups pass a size and a positional
filter, are expanded to their classes, and the classes' whole sets decide.

``join`` asks only for the components of the links, so it leaves out work on links
inside a component; ``links`` then counts all links there.  First round: all pairs of groups that meet in a
shingle of at most ``list_rows`` groups; of longer lists, and of a group's own
classes, each with the first only (the one with the fewest rare shingles, as the
original among its copies).  Second round: every other candidate pair whose two
classes are in different components by then.  No candidate pair is dropped: it
is verified, or its ends are known to be connected.

Sets move only for classes in a candidate pair, found by a bit table of a fixed
size (it may let others pass, never holds one back).  Shingles, sets and classes
are known by 64-bit hashes.

Null and empty texts and texts without words have an empty set, no link and
their own component.  Rows of one doc_id with different texts belong each to
their text's component; a null doc_id links like any other but names no
component.  A table without rows gives none.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsekit.llm.common import id_and_text, job_dir, pieces, release, splitmix, written

BASE = 0x9E3779B97F4A7C15
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def word_hashes(data: bytes, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """A hash of each word data[lo:hi], eight bytes at a time: a word of up to eight
    bytes is told from every other of its length, and each further block is mixed into
    the hash so far, which no fixed pattern of letters undoes."""
    blocks = np.ndarray((len(data) + 1,), "<u8", data + bytes(8), strides=(1,))     # at every byte
    n = hi - lo
    h = splitmix(n.astype(np.uint64))
    at = np.arange(len(lo))
    for done in range(0, int(n.max(initial=0)), 8):
        at = at[n[at] > done]
        used = np.minimum(n[at] - done, 8).astype(np.uint64) * np.uint64(8)
        block = blocks[lo[at] + done] & (np.uint64(0xFFFFFFFFFFFFFFFF) >> (np.uint64(64) - used))
        h[at] = splitmix(h[at] * np.uint64(BASE) ^ block)
    return h


def shingles(texts: list[bytes], words: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, hash) of every distinct shingle, by document, then hash."""
    data = b"\n".join(texts).lower() + b"\n"
    raw = np.frombuffer(data, np.uint8)
    space = SPACE[raw]
    edge = np.flatnonzero(np.diff(space, prepend=True))    # starts and ends by turns
    lo, hi = edge[::2], edge[1::2]
    word = word_hashes(data, lo, hi)
    begin = np.cumsum([0] + [len(t) + 1 for t in texts])
    doc = np.searchsorted(begin, lo, side="right") - 1
    n_words = np.bincount(doc, minlength=len(texts))
    first = np.cumsum(n_words) - n_words
    whole = np.minimum(n_words, words)                     # words of a shingle in each text
    left = first[doc] + n_words[doc] - np.arange(len(doc))  # words from here to the text's end
    at = np.flatnonzero(left >= whole[doc])
    h = splitmix(whole[doc[at]].astype(np.uint64) + np.uint64(77))
    for j in range(words):
        more = whole[doc[at]] > j
        h[more] = splitmix(h[more] * np.uint64(BASE) + word[at[more] + j])
    d = doc[at]
    cut = np.searchsorted(d, np.arange(len(texts) + 1)).tolist()
    for begin, end in zip(cut, cut[1:]):                   # d is ascending
        h[begin:end].sort()
    new = np.ones(len(d), bool)
    new[1:] = (d[1:] != d[:-1]) | (h[1:] != h[:-1])
    return d[new], h[new]


def sums(doc: np.ndarray, h: np.ndarray, n: int) -> np.ndarray:
    """A hash of each document's set that doesn't depend on an order."""
    out = np.zeros(n, np.uint64)
    if len(doc):                                           # doc is ascending
        first = np.flatnonzero(np.diff(doc, prepend=-1))
        out[doc[first]] = np.add.reduceat(splitmix(h ^ np.uint64(0xA5A5A5A5A5A5A5A5)), first)
    return out


def counters(docs: DataFrame, words: int, bits: int, rows: int = 1 << 14) -> np.ndarray:
    """How many sets hold a shingle, summed over the shingles of a counter;
    1 << bits numbers, however large the table is."""
    rows = min(rows, 1 << bits)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros(1 << bits, np.int64)
        for batch in batches:
            for b in pieces(batch, 2_000_000):
                _, h = shingles(b.column(1).cast(pa.binary()).to_pylist(), words)
                count += np.bincount((h >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
        release()
        for lo in range(0, 1 << bits, rows):
            part = count[lo:lo + rows]
            if part.any():
                at = np.flatnonzero(part)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lo], pa.int64()), pa.array([at.astype("<u2").tobytes()]),
                     pa.array([part[at].astype("<u4").tobytes()])], names=["lo", "at", "n"])

    def add(key, t):
        total = np.zeros(rows, np.int64)
        for at, n in zip(t.column("at").to_pylist(), t.column("n").to_pylist()):
            total[np.frombuffer(at, "<u2")] += np.frombuffer(n, "<u4")
        return pa.table({"lo": pa.array([key[0].as_py()], pa.int64()), "n": [total.astype("<i8").tobytes()]})

    summed = (docs.mapInArrow(work, "lo long, at binary, n binary").groupBy("lo")
              .applyInArrow(add, "lo long, n binary"))
    out = np.zeros(1 << bits, np.int64)
    for r in summed.collect():
        out[r["lo"]:r["lo"] + rows] = np.frombuffer(r["n"], np.int64)
    return np.minimum(out, (1 << 31) - 1).astype(np.int32)


SETS = "doc_id long, text_key long, n int, key long, head long, prefix array<long>"


def prefixes(docs: DataFrame, words: int, num: int, den: int, order: np.ndarray) -> DataFrame:
    """Per document the size of its set, the set's key, its prefix's key and,
    once per task and set, the prefix."""
    bits = len(order).bit_length() - 1

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told: set[int] = set()
        for batch in batches:
            for b in pieces(batch, 2_000_000):
                texts = b.column(1).cast(pa.binary()).to_pylist()
                doc, h = shingles(texts, words)
                n = np.bincount(doc, minlength=len(texts))
                key = (sums(doc, h, len(texts)) + n.astype(np.uint64)).view(np.int64)
                # by document, then order; those of one counter stay by hash
                by = np.argsort(doc << 31 | order[(h >> np.uint64(64 - bits)).astype(np.int64)], kind="stable")
                doc, h = doc[by], h[by]
                size = np.where(n > 0, n - -(-num * n // den) + 1, 0)
                start = np.cumsum(n) - n
                keep = np.arange(len(doc)) - start[doc] < size[doc]
                head = (sums(doc[keep], h[keep], len(texts)) + n.astype(np.uint64)).view(np.int64)
                cut = np.concatenate([[0], np.cumsum(size)]).tolist()
                flat = h[keep].view(np.int64)
                lists = []
                for i, k in enumerate(key.tolist()):
                    lists.append(None if k in told or not n[i] else flat[cut[i]:cut[i + 1]])
                    told.add(k)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(2), pa.array(n.astype(np.int32)), pa.array(key), pa.array(head),
                     pa.array(lists, pa.list_(pa.int64()))],
                    names=["doc_id", "text_key", "n", "key", "head", "prefix"])
                if len(told) > 500_000:
                    told.clear()
        release()

    return docs.mapInArrow(work, SETS)


def passes(n_a, n_b, pos_a, pos_b, num: int, den: int):
    """Size and positional filter of two sets that meet at these places of
    their prefixes (numpy arrays)."""
    small, large = np.minimum(n_a, n_b), np.maximum(n_a, n_b)
    need = -(-num * (n_a + n_b) // (num + den))
    return (den * small >= num * large) & (np.minimum(n_a - pos_a, n_b - pos_b) >= need)


#: kind 0: a pair (a, b); kind 1: a row (a) of a long list, for the second round.
MET = "kind int, a long, b long, token long, n int, pos int"


def meet(postings: DataFrame, num: int, den: int, list_rows: int) -> DataFrame:
    """Candidate pairs of the groups (gid) that share a token.  ``postings``:
    token, pos, n, gid."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = np.zeros((4, 0), np.int64)
        hot: tuple[int, np.ndarray] | None = None          # token of a long list, its first row

        def out(kind, a, b, token, n, pos):
            kinds = (pa.int32(), *[pa.int64()] * 3, pa.int32(), pa.int32())
            cols = [np.full(len(a), kind), a, b, token, n, pos]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)],
                                              names=["kind", "a", "b", "token", "n", "pos"])

        def pairs(rows: np.ndarray) -> np.ndarray:
            """All pairs within each token; lists are short here."""
            token, pos, n, gid = rows
            found = []
            for d in range(1, list_rows):
                i = np.flatnonzero(token[d:] == token[:-d]) if len(token) > d else np.zeros(0, int)
                if not len(i):
                    break
                ok = i[passes(n[i], n[i + d], pos[i], pos[i + d], num, den)]
                found.append(np.stack([gid[ok], gid[ok + d]]))
            p = np.concatenate(found, axis=1) if found else np.zeros((2, 0), np.int64)
            return np.unique(np.sort(p, axis=0), axis=1)

        def long_list(rows: np.ndarray, first: np.ndarray):
            token, pos, n, gid = rows
            ok = passes(n, first[2], pos, first[1], num, den) & (gid != first[3])
            a, b = np.minimum(gid, first[3])[ok], np.maximum(gid, first[3])[ok]
            yield out(0, a, b, token[ok], n[ok], pos[ok])
            yield out(1, gid, gid, token, n, pos)

        def closed(rows: np.ndarray):
            """Whole lists."""
            cut = np.flatnonzero(np.diff(rows[0])) + 1
            size = np.diff(np.concatenate([[0], cut, [rows.shape[1]]]))
            long = np.repeat(size > list_rows, size)
            if (~long).any():
                p = pairs(rows[:, ~long])
                if p.shape[1]:
                    z = np.zeros(p.shape[1], np.int64)
                    yield out(0, p[0], p[1], z, z, z)
            rows = rows[:, long]
            for t in np.unique(rows[0]):
                own = rows[:, rows[0] == t]
                yield from long_list(own, own[:, 0])

        for b in batches:
            rows = np.concatenate([rest, np.stack([np.asarray(c).astype(np.int64) for c in b.columns])], axis=1)
            if hot is not None:
                more = rows[0] == hot[0]
                if more.any():
                    yield from long_list(rows[:, more], hot[1])
                    rows = rows[:, ~more]
                if rows.shape[1]:
                    hot = None
            if not rows.shape[1]:
                rest = rows
                continue
            last = int(np.searchsorted(rows[0], rows[0, -1]))
            if last:
                yield from closed(rows[:, :last])
            rest = rows[:, last:]
            if rest.shape[1] > list_rows:
                hot = (rest[0, 0], rest[:, 0])
                yield from long_list(rest, rest[:, 0])
                rest = rest[:, :0]
        if rest.shape[1]:
            yield from closed(rest)

    return (postings.select("token", "pos", "n", "gid").repartition("token")
            .sortWithinPartitions("token", "pos", "n", "gid").mapInArrow(work, MET))


def in_cells(rows: DataFrame, group: str, num: int, den: int, most, folder: str, name: str) -> DataFrame:
    """``rows`` (group, key, n, ...) with ``cells``: where a row is compared.  A
    group's rows are dealt by their size n, so that sets which can link are of one
    class of sizes or of neighbours, and by a hash of the key, into ``most``
    blocks (an aggregate).  Each two blocks that can have a link are one cell
    (group, lo, i, next, j), in which side is 0 or 1; a block with itself is one
    in which side is 0."""
    width = max(math.log(den / num) * (1 + 1e-9), 1e-9)
    sized = rows.withColumn("size", F.floor(F.log(F.col("n").cast("double")) / width))
    many = written(sized.groupBy(group, "size").agg(F.ceil(most).cast("int").alias("blocks")), folder, name)

    def of(shift: int, name: str) -> DataFrame:
        return many.select(group, (F.col("size") + shift).alias("size"), F.col("blocks").alias(name))

    def cells(n: str, lo, i, next_, j, side):
        """The cells of a row with each of the ``n`` blocks."""
        each = F.sequence(F.lit(0), F.col(n) - 1)
        cell = F.transform(each, lambda x: F.struct(lo.alias("lo"), i(x).cast("int").alias("i"), F.lit(next_).alias("next"),
                                                    j(x).cast("int").alias("j"), side(x).cast("int").alias("side")))
        return F.when(F.coalesce(F.col(n), F.lit(0)) > 0, cell).otherwise(F.array().cast(
            "array<struct<lo:bigint,i:int,next:int,j:int,side:int>>"))

    me, size = F.col("me"), F.col("size")
    return (sized.join(many, [group, "size"]).join(of(-1, "above"), [group, "size"], "left")
            .join(of(1, "below"), [group, "size"], "left")
            .withColumn("me", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
            .select(*rows.columns, F.concat(
                cells("blocks", size, lambda x: F.least(x, me), 0, lambda x: F.greatest(x, me), lambda x: me > x),
                cells("above", size, lambda x: me, 1, lambda x: x, lambda x: F.lit(0)),
                cells("below", size - 1, lambda x: x, 1, lambda x: me, lambda x: F.lit(1))).alias("cells")))


def differing(lists: DataFrame, num: int, den: int, folder: str, block: int = 1024) -> DataFrame:
    """Candidate pairs of long lists whose ends have different labels.  ``lists``:
    token, n, pos, key, label.  A task's cell compares two blocks of about
    ``block`` rows of a list."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = np.zeros((10, 0), np.int64)

        def closed(rows: np.ndarray):
            side, (n, pos, key, label) = rows[5], rows[6:]
            own = rows[2, 0] == rows[4, 0] and not rows[3, 0]  # a block with itself
            a, b = (np.arange(len(n)),) * 2 if own else (np.flatnonzero(side == 0), np.flatnonzero(side == 1))
            for lo in range(0, len(a), block):                 # a hash may give a block some more
                x = a[lo:lo + block, None]
                ok = (label[x] != label[None, b]) & passes(n[x], n[None, b], pos[x], pos[None, b], num, den)
                if own:
                    ok &= key[x] < key[None, b]
                i, j = np.nonzero(ok)
                if len(i):
                    p = np.unique(np.sort(np.stack([key[x[i, 0]], key[b[j]]]), axis=0), axis=1)
                    yield pa.RecordBatch.from_arrays([pa.array(p[0]), pa.array(p[1])], names=["a", "b"])

        for b in batches:
            rows = np.concatenate([rest, np.stack([np.asarray(c).astype(np.int64) for c in b.columns])], axis=1)
            cut = np.flatnonzero((np.diff(rows[:5]) != 0).any(axis=0)) + 1
            *whole, rest = np.split(rows, cut, axis=1)
            for part in whole:
                yield from closed(part)
        if rest.shape[1]:
            yield from closed(rest)

    mixed = lists.groupBy("token").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo != hi")
    lists = lists.join(mixed.select("token"), "token", "left_semi").select("token", "n", "pos", "key", "label")
    lists = written(lists, folder, "lists")
    cols = ["token", "lo", "i", "next", "j"]
    return (in_cells(lists, "token", num, den, F.count("*") / F.lit(block), folder, "list_blocks")
            .select(F.explode("cells").alias("cell"), "token", "n", "pos", "key", "label")
            .select("token", "cell.*", "n", "pos", "key", "label")
            .repartition(*cols).sortWithinPartitions(*cols).mapInArrow(work, "a long, b long"))


def whole_sets(docs: DataFrame, words: int, keys: DataFrame, bits: int = 23) -> DataFrame:
    """(key, shingles) of the classes in ``keys`` (key), once each."""

    def marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(1 << bits, bool)
        for b in batches:
            table[place(np.asarray(b.column(0)))] = True
        yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([np.packbits(table).tobytes()])],
                                         names=["one", "bits"])

    def either(key, t):
        out = np.zeros(1 << (bits - 3), np.uint8)
        for x in t.column("bits").to_pylist():
            out |= np.frombuffer(x, np.uint8)
        return pa.table({"bits": [out.tobytes()]})

    def place(key: np.ndarray) -> np.ndarray:
        return (key.view(np.uint64) >> np.uint64(64 - bits)).astype(np.int64)

    # 1 << (bits - 3) bytes come to the driver and go to every task
    got = (keys.coalesce(8).mapInArrow(marks, "one int, bits binary").groupBy("one")
           .applyInArrow(either, "bits binary").collect())
    wanted = np.unpackbits(np.frombuffer(got[0]["bits"], np.uint8)).astype(bool) if got else np.zeros(1 << bits, bool)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told: set[int] = set()
        for batch in batches:
            for b in pieces(batch, 2_000_000):
                texts = b.column(1).cast(pa.binary()).to_pylist()
                doc, h = shingles(texts, words)
                n = np.bincount(doc, minlength=len(texts))
                key = (sums(doc, h, len(texts)) + n.astype(np.uint64)).view(np.int64)
                cut = np.concatenate([[0], np.cumsum(n)]).tolist()
                keep, lists = [], []
                for i in np.flatnonzero(wanted[place(key)] & (n > 0)).tolist():
                    if key[i] not in told:
                        told.add(int(key[i]))
                        keep.append(key[i])
                        lists.append(h[cut[i]:cut[i + 1]].view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keep, pa.int64()), pa.array(lists, pa.list_(pa.int64()))], names=["key", "set"])
        release()

    return (docs.mapInArrow(work, "key long, set array<long>").join(keys, "key", "left_semi")
            .groupBy("key").agg(F.first("set").alias("set")))


def verified(docs: DataFrame, pairs: DataFrame, words: int, num: int, den: int, folder: str, name: str,
             sets: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """The pairs (a, b) of ``pairs`` that reach the threshold, and the whole sets
    (key, set) of their classes.  ``sets``: those known; the texts are read for
    the others only."""
    keys = pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct()
    if sets is not None:
        keys = written(keys.join(sets.select("key"), "key", "left_anti"), folder, f"keys{name}")
    if sets is None or not keys.isEmpty():
        new = written(whole_sets(docs, words, keys), folder, f"sets{name}")
        sets = new if sets is None else sets.unionByName(new)
    both = (pairs.join(sets.select(F.col("key").alias("b"), F.col("set").alias("set_b")), "b")
            .join(sets.select(F.col("key").alias("a"), F.col("set").alias("set_a")), "a"))
    common = F.size(F.array_intersect("set_a", "set_b"))
    return written(both.select("a", "b", common.alias("i"), (F.size("set_a") + F.size("set_b") - common).alias("u"))
                   .where(den * F.col("i") >= num * F.col("u")).select("a", "b"), folder, f"links{name}"), sets


def components(links: DataFrame, folder: str, name: str) -> DataFrame:
    """(key, label) of every end of a link: the smallest key reachable, by
    alternating large-star and small-star steps until nothing changes."""
    edges = written(links.select("a", "b").where("a != b").distinct(), folder, f"edges{name}")
    state = None
    for step in range(100):
        seen = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if (seen["n"], seen["s"]) == state or not seen["n"]:
            break
        state = (seen["n"], seen["s"])
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .where("a != b").distinct())
        # every edge now goes from the larger end to the smaller
        down = written(large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")),
                       folder, f"down{name}-{step}")
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        small = (down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(least.select("a", F.col("m").alias("b"))).where("a != b").distinct())
        edges = written(small, folder, f"edges{name}-{step}")
    else:
        # a round halves the depth, so that this many are never needed
        raise RuntimeError("components are not settled after 100 rounds")
    # all edges are (key, smallest key) now
    return edges.select(F.col("a").alias("key"), F.col("b").alias("label"))


def linked(docs: DataFrame, words: int, num: int, den: int, list_rows: int, sketch_bits: int, folder: str,
           block: int = 1024):
    """The tables (sets, classes), the links that the search needed (a, b),
    (key, label) of every end of one, and the whole sets (key, set) of all ends."""
    rows = id_and_text(docs).withColumn("text_key", F.xxhash64("text"))
    order = counters(rows, words, sketch_bits)
    sets = written(prefixes(rows, words, num, den, order), folder, "prefixes")
    classes = written(sets.where("n > 0").groupBy("key").agg(F.first("n").alias("n"), F.first("head").alias("head")),
                      folder, "classes")
    # a group is known by its first class; its prefix comes from any class that told it
    groups = written(classes.groupBy("n", "head").agg(F.min("key").alias("gid"), F.count("*").alias("size")),
                     folder, "groups")
    told = sets.where("prefix is not null").groupBy("n", "head").agg(F.first("prefix").alias("prefix"))
    postings = (groups.join(told, ["n", "head"])
                .select("gid", "n", F.posexplode("prefix").alias("pos", "token")))
    met = written(meet(postings, num, den, list_rows), folder, "met")
    group_pairs = met.where("kind = 0").select("a", "b").distinct()
    members = written(classes.join(groups.where("size > 1"), ["n", "head"]).select("gid", "key", "n"), folder, "members")
    stars = members.where("gid != key").select(F.col("gid").alias("a"), F.col("key").alias("b"))
    links, whole = verified(rows, group_pairs.unionByName(stars), words, num, den, folder, "1")
    labels = components(links, folder, "1")

    # second round: what is left between different components
    def labelled(df: DataFrame, key: str, label: str) -> DataFrame:
        own = labels.select(F.col("key").alias(key), F.col("label").alias(label))
        return df.join(own, key, "left").withColumn(label, F.coalesce(label, F.col(key)))

    grown = members.select("gid", "key")
    span = written(labelled(grown, "key", "label").groupBy("gid").agg(F.min("label").alias("lo"), F.max("label").alias("hi")),
                   folder, "span")

    def spanned(df: DataFrame, gid: str) -> DataFrame:
        """With the least and the largest label of a group's classes."""
        return (labelled(df, gid, f"own_{gid}").join(span.select(
            F.col("gid").alias(gid), F.col("lo").alias(f"lo_{gid}"), F.col("hi").alias(f"hi_{gid}")), gid, "left")
            .withColumn(f"many_{gid}", F.col(f"lo_{gid}").isNotNull())
            .withColumn(f"lo_{gid}", F.coalesce(f"lo_{gid}", f"own_{gid}"))
            .withColumn(f"hi_{gid}", F.coalesce(f"hi_{gid}", f"own_{gid}")))

    open_pairs = (spanned(spanned(group_pairs, "a"), "b").where("many_a or many_b")
                  .where("not (lo_a = hi_a and lo_b = hi_b and lo_a = lo_b)").select("a", "b"))
    of_a = grown.select(F.col("gid").alias("a"), F.col("key").alias("key_a"))
    of_b = grown.select(F.col("gid").alias("b"), F.col("key").alias("key_b"))
    expanded = (open_pairs.join(of_a, "a", "left").join(of_b, "b", "left")
                .select(F.coalesce("key_a", "a").alias("a"), F.coalesce("key_b", "b").alias("b")))
    left = labelled(labelled(expanded, "a", "la"), "b", "lb").where("la != lb").select("a", "b")
    # long lists, and the classes of a group, which meet in all of their prefix
    lists = (met.where("kind = 1").select(F.col("a").alias("gid"), "token", "n", "pos")
             .join(grown, "gid", "left").select("token", "n", "pos", F.coalesce("key", "gid").alias("key")))
    lists = lists.unionByName(members.select(F.col("gid").alias("token"), "n", F.lit(0).alias("pos"), "key"))
    left = left.unionByName(differing(labelled(lists, "key", "label"), num, den, folder, block))
    left = written(left.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), folder, "left")
    if not left.isEmpty():
        more, whole = verified(rows, left, words, num, den, folder, "2", whole)
        if not more.isEmpty():
            links = links.unionByName(more)
            labels = components(links, folder, "2")

    return sets, classes, links, labels, whole


def all_links(whole: DataFrame, classes: DataFrame, labels: DataFrame, num: int, den: int,
              folder: str, block: int = 1024, shingles_: int = 500_000) -> DataFrame:
    """(key, links): with how many other classes a class links, of classes with a
    link.  ``whole``: (key, set) of them at least; the search has verified their
    links, so that no text is read again.  A link's ends share a component, and the smaller set has at least
    num / den of the larger one's shingles: a component's classes are dealt by
    that ratio of sizes, and by a hash of the class, into blocks of about
    ``block`` rows and at most about ``shingles_`` shingles.  A task's cell
    compares two blocks on whole sets, so no list is cut, no pair becomes a row,
    and each pair is in one cell."""
    ends = labels.unionByName(labels.select(F.col("label").alias("key"), "label").distinct())
    ends = ends.join(classes.select("key", "n"), "key")
    most = F.greatest(F.count("*") / F.lit(block), F.sum("n") / F.lit(shingles_))
    placed = in_cells(ends, "label", num, den, most, folder, "blocks")
    dealt = (placed.join(whole, "key").select("label", F.explode("cells").alias("cell"), "key", "set")
             .select("label", "cell.*", "key", "set"))

    def compare(name: tuple, side: np.ndarray, key: np.ndarray, sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """(key, links within the cell)."""
        own = name[2] == name[4] and not name[3]           # a block with itself
        n = np.array([len(x) for x in sets], np.int64)
        row = np.repeat(np.arange(len(sets)), n)
        _, at, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        more = count > 1                                   # only these can be shared
        renamed = np.cumsum(more) - 1
        row, at = row[more[at]], renamed[at[more[at]]]
        by = np.argsort(at, kind="stable")
        row, at = row[by], at[by]
        a, b = (np.arange(len(sets)),) * 2 if own else (np.flatnonzero(side == 0), np.flatnonzero(side == 1))
        common = np.zeros((len(a), len(b)), np.float32)
        total = int(more.sum())
        for lo in range(0, total, 2048):
            p, q = np.searchsorted(at, [lo, lo + 2048])
            held = np.zeros((len(sets), min(2048, total - lo)), np.float32)
            held[row[p:q], at[p:q] - lo] = 1
            common += held[a] @ held[b].T
        common = common.astype(np.int64)
        link = den * common >= num * (n[a, None] + n[None, b] - common)
        if own:
            np.fill_diagonal(link, False)
            return key, link.sum(axis=1)
        return np.concatenate([key[a], key[b]]), np.concatenate([link.sum(axis=1), link.sum(axis=0)])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, held = None, []

        def closed():
            side, key = (np.array([x[k] for x in held], np.int64) for k in (0, 1))
            out = compare(name, side, key, [x[2] for x in held])
            return pa.RecordBatch.from_arrays([pa.array(v.astype(np.int64)) for v in out], names=["key", "links"])

        for b in batches:
            names = zip(*(b.column(k).to_pylist() for k in range(5)))
            for i, (new, side, key) in enumerate(zip(names, b.column(5).to_pylist(), b.column(6).to_pylist())):
                if new != name and held:
                    yield closed()
                    held = []
                name = new
                # copied: a view would hold the whole batch
                held.append((side, key, np.array(b.column(7)[i].values)))
        if held:
            yield closed()
        release()

    cols = ["label", "lo", "i", "next", "j"]
    return (dealt.repartition(*cols).sortWithinPartitions(*cols).select(*cols, "side", "key", "set")
            .mapInArrow(work, "key long, links long").groupBy("key").agg(F.sum("links").alias("links")))


def links(docs: DataFrame, words: int = 5, num: int = 4, den: int = 5, list_rows: int = 64, sketch_bits: int = 20,
          block: int = 1024) -> DataFrame:
    """doc_id, n_shingles, links and, to find the row again, text_key, of every row:
    links is with how many other sets the document's set links, all of them
    verified.  Documents with one set are one."""
    folder = job_dir(docs.sparkSession, "jaccard")
    sets, classes, _, labels, whole = linked(docs, words, num, den, list_rows, sketch_bits, folder, block)
    found = written(all_links(whole, classes, labels, num, den, folder, block), folder, "all")
    return (sets.join(found, "key", "left")
            .select("doc_id", F.col("n").cast("long").alias("n_shingles"),
                    F.coalesce("links", F.lit(0)).cast("long").alias("links"), "text_key"))


def join(docs: DataFrame, words: int = 5, num: int = 4, den: int = 5, list_rows: int = 64,
         sketch_bits: int = 20, block: int = 1024) -> DataFrame:
    """doc_id, n_shingles, component_id and links_seen (links of the document's set
    that the search needed; ``links`` counts all) of every row, and, to find it
    again, text_key; stays is true for one document of each component, that of the
    smallest doc_id (its repeated rows share it).  Sets link when
    den * intersection >= num * union."""
    folder = job_dir(docs.sparkSession, "jaccard")
    sets, classes, links, labels, _ = linked(docs, words, num, den, list_rows, sketch_bits, folder, block)
    degree = (links.select(F.explode(F.array("a", "b")).alias("key")).groupBy("key")
              .agg(F.count("*").alias("links")))
    named = (classes.select("key").join(labels, "key", "left").withColumn("label", F.coalesce("label", "key"))
             .join(degree, "key", "left"))
    ids = sets.select("doc_id", "text_key", "n", "key")
    me = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")
    firsts = ids.where("n > 0").groupBy("key").agg(F.min(me).alias("first"))
    component = named.join(firsts, "key").groupBy("label").agg(F.min("first").alias("first"))
    table = named.join(component, "label").select("key", "first", F.coalesce("links", F.lit(0)).alias("links"))
    has = F.col("n") > 0
    return (ids.join(table, "key", "left")
            .select("doc_id", F.col("n").cast("long").alias("n_shingles"),
                    F.when(has, F.col("first.doc_id")).otherwise(F.col("doc_id")).alias("component_id"),
                    F.coalesce("links", F.lit(0)).cast("long").alias("links_seen"),
                    "text_key", (~has | (F.col("first") == me)).alias("stays")))
