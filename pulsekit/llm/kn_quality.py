"""Operator 1: quality by perplexity under a modified Kneser-Ney model.

The model's symbols are the bytes of the UTF-8 text, an n-gram is one long
integer, and the text begins with ``order`` - 1 zero bytes.  Counts of the
trusted texts' n-grams are a table; lower orders count the distinct n-grams
that end so; the discounts of each order come from its counts of counts; a
table of probabilities and one of back-off weights follow by joins on contexts
and shorter n-grams, order by order.

Which documents are trusted is looked up by id, block by block, and written to
the shared folder, so that the counting reads texts where they are.

Documents are read in blocks.  A block asks for its distinct n-grams, packed by
shard; the distinct n-grams of all blocks are joined to the tables, and those
not seen in training back off by further joins, order by order; each shard then
answers the blocks, and the blocks' answers are written to the shared folder,
where the second reading of the documents finds them.  Only n-grams move, once
per block and not once per occurrence; texts never do.

A text's perplexity is per byte.  Of the trusted texts a fifth, by a hash of the
text, is not counted: its perplexities' quantile, by language, is the threshold.
Texts of languages without such rows get the quantile over all languages.

Null and empty texts have no perplexity and are rejected.  A null language is
one of its own.  Null doc_id and repeated rows are rows like any others.  Without
trusted rows nothing is known and every text that isn't empty is kept.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsekit.llm.common import job_dir, pieces, release, splitmix, written

#: Probability of a byte of which nothing is known.
FLAT = 1 / 256
#: Text whose n-grams are sorted at once, and of a block.
PIECE_BYTES = 2_000_000
BLOCK_BYTES = 16_000_000
#: A table of a row per language goes to every task if it has at most so many.
MOST_LANGUAGES = 10_000


def ngram_keys(text: bytes, order: int) -> np.ndarray:
    """The n-gram that ends at each byte, as a number below 256 ** order."""
    x = np.zeros(len(text) + order - 1, np.int64)
    x[order - 1:] = np.frombuffer(text, np.uint8)
    key = x[:len(text)].copy()
    for k in range(1, order):
        key <<= 8
        key |= x[k:k + len(text)]
    return key


def distinct(texts: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """(n-grams in ascending order, their counts)."""
    keys = np.concatenate([np.zeros(0, np.int64)] + [ngram_keys(t, order) for t in texts])
    keys.sort()
    first = np.flatnonzero(np.concatenate([[True] * bool(len(keys)), keys[1:] != keys[:-1]]))
    return keys[first], np.diff(np.append(first, len(keys)))


def merged(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    keys, at = np.unique(np.concatenate([a[0], b[0]]), return_inverse=True)
    return keys, np.bincount(at, np.concatenate([a[1], b[1]]), len(keys)).astype(np.int64)


def pack_keys(keys: np.ndarray) -> bytes:
    return zlib.compress(np.ascontiguousarray(np.diff(keys, prepend=0).view(np.uint8).reshape(-1, 8).T).tobytes(), 1)


def unpack_keys(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(data), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.int64).ravel())


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    return (splitmix(keys.astype(np.uint64)) >> np.uint64(40)).astype(np.int64) % shards


class Lookup:
    """Open-addressing table from keys to their places, for arrays of keys."""

    def __init__(self, keys: np.ndarray):
        self.bits = max(8, int(len(keys) * 2).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.at = np.zeros(1 << self.bits, np.int32)
        todo, slot = np.arange(len(keys)), self.home(keys)
        while len(todo):
            free = self.keys[slot] == -1
            self.keys[slot[free]] = keys[todo[free]]           # of several, the last stays
            self.at[slot[free]] = todo[free]
            lost = self.keys[slot] != keys[todo]
            todo, slot = todo[lost], (slot[lost] + 1) & ((1 << self.bits) - 1)

    def home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        slot = self.home(keys)
        todo = np.flatnonzero(self.keys[slot] != keys)
        while len(todo):
            slot[todo] = (slot[todo] + 1) & ((1 << self.bits) - 1)
            todo = todo[self.keys[slot[todo]] != keys[todo]]
        return self.at[slot]


def blocks_of(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[str, list[pa.RecordBatch]]]:
    """(name, batches) of about ``size`` bytes of text each.  The name tells the
    task's partition, the block's number and a checksum of its texts: a second
    reading that sees other rows finds no answers under its name."""
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    held: list[pa.RecordBatch] = []
    n, seq = 0, 0

    def name() -> str:
        crc = 0
        for b in held:
            for t in b.column(0).cast(pa.binary()):
                crc = zlib.crc32(t.as_buffer(), crc)
        return f"{part:07d}-{seq:04d}-{crc:08x}"

    for batch in batches:
        for b in pieces(batch, min(size, PIECE_BYTES)):
            held.append(b)
            n += b.column(0).nbytes
            if n >= size:
                yield name(), held
                held, n, seq = [], 0, seq + 1
    if held:
        yield name(), held
    held = []
    release()


def raw_texts(b: pa.RecordBatch) -> list[bytes]:
    return b.column(0).cast(pa.binary()).to_pylist()


def put_files(parts: DataFrame, folder: str) -> DataFrame:
    """The column ``data`` of a block's rows, in the order of ``part``, becomes
    the file ``folder``/block; a row per file."""

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        store, root = file_store(folder)
        store.create_dir(root, recursive=True)
        block, held = None, []

        def close():
            own = f"{root}/_{block}.{TaskContext.get().taskAttemptId()}"
            with store.open_output_stream(own) as f:
                f.write(b"".join(held))
            store.move(own, f"{root}/{block}")
            return pa.RecordBatch.from_arrays([pa.array([block])], names=["block"])

        for b in batches:
            for name, data in zip(b.column(0).to_pylist(), b.column(2).to_pylist()):
                if block not in (None, name):
                    yield close()
                    held = []
                block = name
                held.append(data)
        if block:
            yield close()

    return (parts.select("block", "part", "data").repartition("block").sortWithinPartitions("block", "part")
            .mapInArrow(put, "block string"))


def file_store(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")


def get_file(store, root: str, block: str) -> bytes:
    from pyarrow import fs

    if store.get_file_info(f"{root}/{block}").type == fs.FileType.NotFound:
        raise ValueError("the documents came in another order on their second reading: write the table first")
    with store.open_input_file(f"{root}/{block}") as f:
        return f.read()


def marked(docs: DataFrame, ids: DataFrame, folder: str, block_bytes: int) -> str:
    """A folder with a file for each block of ``docs`` (text, doc_id, ...): a byte
    per document, 1 if its doc_id is in ``ids``.  Only ids move."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, held in blocks_of(batches, block_bytes):
            at = 0
            for b in held:
                n = b.num_rows
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * n), pa.array(np.arange(at, at + n)), b.column(1)], names=["block", "part", "id"])
                at += n

    asked = docs.mapInArrow(ask, "block string, part long, id long")
    known = ids.select(F.col("doc_id").alias("id"), F.lit(1).alias("yes"))
    bit = F.when(F.col("yes") == 1, F.unhex(F.lit("01"))).otherwise(F.unhex(F.lit("00")))
    files = put_files(asked.join(known, "id", "left").select("block", "part", bit.alias("data")), f"{folder}/marks")
    written(files, folder, "marked")
    return f"{folder}/marks"


def count_marked(docs: DataFrame, marks: str, order: int, block_bytes: int, limit: int = 1_000_000) -> DataFrame:
    """As ``count_ngrams``, of the marked texts that are not held back."""

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = file_store(marks)
        for name, held in blocks_of(batches, block_bytes):
            data = np.frombuffer(get_file(store, root, name), np.uint8)
            at = 0
            for b in held:
                use = (data[at:at + b.num_rows] == 1) & ~np.asarray(b.column(2))
                at += b.num_rows
                yield b.filter(pa.array(use))

    return count_ngrams(docs, order, limit, texts)


def count_ngrams(texts: DataFrame, order: int, limit: int = 1_000_000, chosen=lambda batches: batches) -> DataFrame:
    """(g, c) of the first column of a table (text), of the rows that ``chosen``
    leaves; a task adds up to ``limit`` distinct n-grams before it passes them
    on."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = (np.zeros(0, np.int64), np.zeros(0, np.int64))

        def rows(x):
            for lo in range(0, len(x[0]), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(v[lo:lo + 100_000]) for v in x], names=["g", "c"])

        for batch in chosen(batches):
            for b in pieces(batch, PIECE_BYTES):
                held = merged(held, distinct(raw_texts(b), order))
                if len(held[0]) > limit:
                    yield from rows(held)
                    held = (held[0][:0], held[1][:0])
        yield from rows(held)

    return texts.mapInArrow(work, "g long, c long").groupBy("g").agg(F.sum("c").alias("c"))


class Model:
    """Tables of each order k: ``seen[k]`` (g, p) and, for contexts of the order,
    ``back[k]`` (h, w): what is left for shorter contexts."""

    def __init__(self, ngrams: DataFrame, order: int, folder: str):
        """``ngrams``: (g, c) of the trusted texts, of the order."""
        self.order, self.folder = order, folder
        counts = {order: written(ngrams, folder, f"counts{order}")}
        for k in range(order - 1, 0, -1):
            shorter = counts[k + 1].select((F.col("g") % (1 << 8 * k)).alias("g"))
            counts[k] = written(shorter.groupBy("g").agg(F.count("*").alias("c")), folder, f"counts{k}")
        # four counts of counts of each order come to the driver
        tops = None
        for k, c in counts.items():
            t = c.where("c <= 4").groupBy("c").agg(F.count("*").alias("n")).select(F.lit(k).alias("k"), "c", "n")
            tops = t if tops is None else tops.unionByName(t)
        n = {(r["k"], r["c"]): r["n"] for r in tops.collect()}
        self.seen: dict[int, DataFrame] = {}
        self.back: dict[int, DataFrame] = {}
        for k in range(1, order + 1):
            n1, n2, n3, n4 = (n.get((k, i), 0) for i in (1, 2, 3, 4))
            y = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5
            d = [min(max(i - (i + 1) * y * b / a, 0.05), i - 0.05) if a and b else 0.5 * i
                 for i, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4))]
            off = F.when(F.col("c") == 1, d[0]).when(F.col("c") == 2, d[1]).otherwise(d[2])
            with_context = counts[k].select("g", "c", off.alias("off"), F.shiftright("g", 8).alias("h"))
            context = with_context.groupBy("h").agg(F.sum("c").alias("total"), (F.sum("off") / F.sum("c")).alias("w"))
            self.back[k] = written(context, folder, f"back{k}")
            p = with_context.join(self.back[k], "h")
            own = (F.col("c") - F.col("off")) / F.col("total")
            if k == 1:
                p = p.select("g", (own + F.col("w") * FLAT).alias("p"))
            else:
                below = self.seen[k - 1].select(F.col("g").alias("s"), F.col("p").alias("q"))
                p = (p.withColumn("s", F.col("g") % (1 << 8 * (k - 1))).join(below, "s")
                     .select("g", (own + F.col("w") * F.col("q")).alias("p")))
            self.seen[k] = written(p, folder, f"seen{k}")

    def log_probabilities(self, asked: DataFrame) -> DataFrame:
        """(g, lp) for every n-gram of ``asked`` (g, distinct).  What an order finds is
        written, so that the orders below don't find it again: their joins would
        grow with the square of the order, in tasks and in the driver's plans."""
        rest = asked.select("g", F.lit(1.0).alias("w"))
        folder, out = f"{self.folder}/asked-{uuid.uuid4().hex[:12]}", None
        for k in range(self.order, 0, -1):
            # s: the last k bytes
            p = rest.withColumn("s", F.col("g") % (1 << 8 * k)).join(
                self.seen[k].select(F.col("g").alias("s"), "p"), "s", "left").select("g", "w", "p")
            p = written(p, folder, f"order{k}")
            found = p.where("p is not null").select("g", F.log(F.col("w") * F.col("p")).alias("lp"))
            out = found if out is None else out.unionByName(found)
            back = self.back[k].select("h", F.col("w").alias("v"))
            rest = (p.where("p is null").withColumn("h", F.shiftright(F.col("g") % (1 << 8 * k), 8)).join(back, "h", "left")
                    .select("g", (F.col("w") * F.coalesce("v", F.lit(1.0))).alias("w")))
        return out.unionByName(rest.select("g", F.log(F.col("w") * FLAT).alias("lp")))


def perplexities(docs: DataFrame, model: Model, folder: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` (text, then other columns of the caller) with ``perplexity``."""
    spark = docs.sparkSession
    order = model.order
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, held in blocks_of(batches, block_bytes):
            keys = np.zeros(0, np.int64)
            for b in held:
                keys = np.union1d(keys, distinct(raw_texts(b), order)[0])
            shard = shard_of(keys, shards)
            by = np.argsort(shard, kind="stable")
            cut = np.searchsorted(shard[by], np.arange(shards + 1))
            for s in range(shards):
                if cut[s + 1] > cut[s]:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([s], pa.int32()), pa.array([name]), pa.array([pack_keys(keys[by[cut[s]:cut[s + 1]]])])],
                        names=["shard", "block", "keys"])

    def several(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The distinct n-grams that the requests of a shard ask for."""
        keys = np.zeros(0, np.int64)
        for b in batches:
            keys = np.unique(np.concatenate([keys] + [unpack_keys(x.as_py()) for x in b.column(2)]))
        for lo in range(0, len(keys), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(keys[lo:lo + 100_000])], names=["g"])

    def packed(key, t):
        g = np.asarray(t.column("g").combine_chunks())
        by = np.argsort(g)
        lp = np.asarray(t.column("lp").combine_chunks())[by].astype(np.float32)
        return pa.table({"shard": pa.array([key[0].as_py()], pa.int32()), "known": [pack_keys(g[by])], "lp": [lp.tobytes()]})

    def answer(key, left, right):
        known, lp = unpack_keys(left.column("known")[0].as_py()), np.frombuffer(left.column("lp")[0].as_py(), np.float32)
        got = [lp[np.searchsorted(known, unpack_keys(x.as_py()))].tobytes() for x in right.column("keys")]
        return pa.table({"block": right.column("block"), "shard": right.column("shard"), "lp": pa.array(got, pa.binary())})

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = file_store(answers)
        for name, held in blocks_of(batches, block_bytes):
            keys = np.zeros(0, np.int64)
            for b in held:
                keys = np.union1d(keys, distinct(raw_texts(b), order)[0])
            lp = np.zeros(0, np.float32)
            if len(keys):
                lp = np.frombuffer(get_file(store, root, name), np.float32)
                keys = keys[np.argsort(shard_of(keys, shards), kind="stable")]
            find = Lookup(keys)
            for b in held:
                texts = raw_texts(b)
                sizes = np.array([len(t) for t in texts], np.int64)
                out = np.full(len(texts), np.nan)
                for i in np.flatnonzero(sizes).tolist():
                    out[i] = np.exp(-lp[find(ngram_keys(texts[i], order))].mean(dtype=np.float64))
                yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(out, mask=sizes == 0)],
                                                 names=[*b.schema.names[1:], "perplexity"])

    answers = f"{folder}/answers"
    requests = written(docs.mapInArrow(ask, "shard int, block string, keys binary").repartition(shards, "shard"),
                       folder, "requests")
    asked = requests.repartition(shards, "shard").mapInArrow(several, "g long")
    known = model.log_probabilities(asked)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [pa.array(shard_of(np.asarray(b.column(0)), shards).astype(np.int32)), *b.columns], names=["shard", "g", "lp"])

    tables = (known.mapInArrow(number, "shard int, g long, lp double").groupBy("shard")
              .applyInArrow(packed, "shard int, known binary, lp binary"))
    answered = (tables.groupBy("shard").cogroup(requests.groupBy("shard"))
                .applyInArrow(answer, "block string, shard int, lp binary"))
    written(put_files(answered.select("block", F.col("shard").alias("part"), F.col("lp").alias("data")), answers),
            folder, "answered")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields[1:])
    return docs.mapInArrow(score, f"{fields}, perplexity double")


def held_back():
    """The trusted texts that set the thresholds and are not counted."""
    return F.pmod(F.xxhash64("text"), F.lit(5)) == 0


def quality(docs: DataFrame, trusted_ids: DataFrame, order: int = 5, quantile: float = 0.95,
            margin: float = 1.05, prior_bytes: int = 400) -> DataFrame:
    """doc_id, lang, perplexity, smoothed, threshold and keep of every row, and,
    to find the row again, text_key.
    ``trusted_ids``: a column doc_id.  A few bytes tell little, so a perplexity
    is smoothed by ``prior_bytes`` bytes at the median of the language's trusted
    texts; a text is kept when that is at most ``margin`` times the ``quantile``
    of its language's trusted texts.  A higher quantile is set by one or two short
    texts full of numbers, and long texts of a repeated word pass it."""
    folder = job_dir(docs.sparkSession, "quality")
    rows = docs.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
                       F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
                       F.octet_length(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("n"),
                       F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("text_key"))
    trusted = written(trusted_ids.select(F.col("doc_id").cast("long").alias("doc_id"))
                      .where("doc_id is not null").distinct(), folder, "trusted")
    rows = rows.select("text", "doc_id", held_back().alias("back"), "lang", "n", "text_key")
    marks = marked(rows, trusted, folder, BLOCK_BYTES)
    model = Model(count_marked(rows, marks, order, BLOCK_BYTES), order, folder)
    scored = written(perplexities(rows, model, folder), folder, "scored")
    judges = scored.join(trusted, "doc_id", "left_semi").where("back and perplexity is not null")

    few = scored.agg(F.approx_count_distinct("lang").alias("n")).first()["n"] <= MOST_LANGUAGES

    def by_language(df: DataFrame, judges: DataFrame, column: str, q: float, name: str) -> DataFrame:
        """``df`` with the quantile of its language's judges, or of all: those
        of all languages are one number, which comes to the driver."""
        at = F.percentile_approx(column, q, 100_000)
        every = judges.agg(at.alias("t")).first()["t"]
        own = judges.groupBy("lang").agg(at.alias(name))
        own = F.broadcast(own) if few else own
        return (df.join(own, "lang", "left")
                .withColumn(name, F.coalesce(name, F.lit(every).cast("double"))))

    def smooth(df: DataFrame) -> DataFrame:
        share = F.col("n") / (F.col("n") + prior_bytes)
        middle = by_language(df, judges, "perplexity", 0.5, "middle")
        return middle.withColumn("smoothed", F.exp(
            share * F.log("perplexity") + (1 - share) * F.log(F.coalesce("middle", "perplexity"))))

    return (by_language(smooth(scored), smooth(judges), "smoothed", quantile, "threshold")
            .withColumn("threshold", F.col("threshold") * margin)
            .select("doc_id", "text_key", "lang", "perplexity", "smoothed", "threshold",
                    (F.col("perplexity").isNotNull()
                     & F.coalesce(F.col("smoothed") <= F.col("threshold"), F.lit(True))).alias("keep")))
