"""Operator 3: token ids in binary files, Simple-8b coded.

A word has 64 bits: a 4-bit selector (the top bits) and 60 bits of payload, or
an escape.  Selector s packs COUNTS[s] ids of WIDTHS[s] bits, first id in the
low bits; selector 0 is the escape: the next word is one whole 64-bit id.
A block holds BLOCK ids (the last block fewer) and starts on a word, and the
file's table gives each block's first word, so blocks decode independently and
all words of one selector decode at once.

File (little endian): 8 bytes magic, then int64 n_docs, n_ids, n_blocks,
n_words; n_docs x int64 doc_id; n_docs x int64 ids of the document;
(n_blocks + 1) x int64 first word of each block; n_words x uint64.

Files hold ranges of doc_id in ascending order.  Null doc_id sort first; rows
of one doc_id sort by text, so repeated rows keep their number.  Empty texts
hold only the end id; a table without rows gives no file and no row.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsekit.llm.common import id_and_text, job_dir, pieces, release, written
from pulsekit.llm.units import encoder, forget

MAGIC = b"PKS8B\0\0\1"
BLOCK = 2048
#: Ids per word and bits per id of selectors 1..14; selector 0 is the escape.
COUNTS = np.array([0, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
WIDTHS = np.array([0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])


def pack(ids: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """(words, first word of each block and the end).  In each block the
    selectors are chosen greedily, the most ids first; all blocks advance
    together, a word of each at a time."""
    ids = np.ascontiguousarray(ids, np.uint64)
    n = len(ids)
    n_blocks = -(-n // block)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(1, np.int64)
    ends = np.minimum((np.arange(n_blocks) + 1) * block, n)
    # need: the first selector wide enough for each id (15: none, so an escape);
    # choice: the first selector wide enough for as many ids as it holds
    limits = (1 << WIDTHS[1:]).astype(np.uint64)
    if int(ids.max()) < 65536:
        need = np.searchsorted(limits, np.arange(65536, dtype=np.uint64), side="right"
                               ).astype(np.uint8)[ids] + np.uint8(1)
    else:
        need = (np.searchsorted(limits, ids, side="right") + 1).astype(np.uint8)
    most = {1: need}
    for c in COUNTS[:0:-1].tolist():
        if c > 1:       # the maximum over c ids from two overlapping runs of known maximum
            half = max(x for x in most if 2 * x >= c and x < c or x == max(most))
            left = most[half]
            most[c] = np.maximum(left, np.concatenate([left[c - half:], np.zeros(c - half, np.uint8)])[:n])
    choice = np.zeros(n, np.uint8)
    for s in range(14, 0, -1):
        np.copyto(choice, np.uint8(s), where=most[int(COUNTS[s])] <= s)
    at = np.arange(n_blocks) * block
    heads, owners = [], []
    live = np.arange(n_blocks)
    while len(live):
        heads.append(at[live].copy())
        owners.append(live)
        step = COUNTS[choice[at[live]]]
        at[live] += np.where(step == 0, 1, step)
        live = live[at[live] < ends[live]]
    head, owner = np.concatenate(heads), np.concatenate(owners)
    order = np.argsort(head, kind="stable")
    head, owner = head[order], owner[order]
    sel = choice[head].astype(np.int64)
    slots = np.where(sel == 0, 2, 1)
    where = np.concatenate([[0], np.cumsum(slots)])
    words = np.zeros(where[-1], np.uint64)
    stop = ends[owner]
    for s in range(15):
        rows = np.flatnonzero(sel == s)
        if not len(rows):
            continue
        if s == 0:
            words[where[rows] + 1] = ids[head[rows]]
            continue
        # a block's last word may hold fewer: ids beyond the end are not this word's
        filled = head[rows] + int(COUNTS[s]) <= stop[rows]
        for own, whole in ((rows[filled], True), (rows[~filled], False)):
            value = np.full(len(own), s << 60, np.uint64)
            at = head[own]
            for j in range(int(COUNTS[s]) if len(own) else 0):
                v = ids[at] if whole else np.where(at < stop[own], ids[np.minimum(at, n - 1)], np.uint64(0))
                v <<= np.uint64(j * int(WIDTHS[s]))
                value |= v
                at += 1
            words[where[own]] = value
    starts = np.searchsorted(owner, np.arange(n_blocks))
    return words, np.concatenate([where[starts], [where[-1]]])


def unpack(words: np.ndarray, starts: np.ndarray, n: int, block: int = BLOCK) -> np.ndarray:
    """The ids; inverse of ``pack``."""
    out = np.zeros(n, np.uint64)
    if not n:
        return out
    sel = (words >> np.uint64(60)).astype(np.int64)
    # the word after an escape is an id; as escapes may follow each other, a
    # run of zero selectors is read from its start, two words at a time
    plain = np.ones(len(words), bool)
    zero = np.flatnonzero(sel == 0)
    if len(zero):
        skip = -1
        for z in zero.tolist():
            if z == skip:
                continue
            plain[z + 1] = False
            skip = z + 1
    at = np.flatnonzero(plain)
    sel = sel[at]
    count = np.where(sel == 0, 1, COUNTS[sel])
    b = np.searchsorted(starts, at, side="right") - 1
    before = np.concatenate([[0], np.cumsum(count)])[:-1]
    firsts = np.searchsorted(at, starts[:-1])
    pos = before - before[firsts][b] + b * block
    stop = np.minimum((b + 1) * block, n)
    for s in range(15):
        rows = np.flatnonzero(sel == s)
        if not len(rows):
            continue
        if s == 0:
            out[pos[rows]] = words[at[rows] + 1]
            continue
        width, mask = np.uint64(WIDTHS[s]), np.uint64((1 << int(WIDTHS[s])) - 1)
        filled = pos[rows] + int(COUNTS[s]) <= stop[rows]
        for own, whole in ((rows[filled], True), (rows[~filled], False)):
            w, to = words[at[own]], pos[own]
            for _ in range(int(COUNTS[s]) if len(own) else 0):
                if whole:
                    out[to] = w & mask
                else:
                    ok = to < stop[own]
                    out[to[ok]] = w[ok] & mask
                w >>= width
                to += 1
    return out


def to_bytes(doc_ids: np.ndarray, lens: np.ndarray, ids: np.ndarray) -> bytes:
    words, starts = pack(ids)
    head = np.array([len(doc_ids), len(ids), len(starts) - 1, len(words)], "<i8")
    return b"".join([MAGIC, head.tobytes(), doc_ids.astype("<i8").tobytes(),
                     lens.astype("<i8").tobytes(), starts.astype("<i8").tobytes(),
                     words.astype("<u8").tobytes()])


def from_bytes(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doc_ids, ids of each document, all ids)."""
    if data[:8] != MAGIC:
        raise ValueError("not a token file")
    n_docs, n_ids, n_blocks, n_words = np.frombuffer(data, "<i8", 4, 8).tolist()
    at = 40
    doc_ids = np.frombuffer(data, "<i8", n_docs, at)
    lens = np.frombuffer(data, "<i8", n_docs, at + 8 * n_docs)
    at += 16 * n_docs
    starts = np.frombuffer(data, "<i8", n_blocks + 1, at)
    words = np.frombuffer(data, "<u8", n_words, at + 8 * (n_blocks + 1))
    return doc_ids, lens, unpack(words, starts, n_ids)


#: Stands for a null doc_id in a file.
NULL_ID = -(1 << 63)

#: Tasks that read files back; beyond it a task reads several.
MOST_READERS = 20_000

MANIFEST = "part long, seq long, file string, n_docs long, n_ids long"
TOKENS = "doc_id long, start long, n_tokens long, ids_crc32 long"


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, end_id: int,
                 file_ids: int = 4_000_000) -> DataFrame:
    """Encode every text, append ``end_id`` and write the files; one row per
    file.  Each task writes its range as files of about ``file_ids`` ids, under a
    name of its own attempt that is then renamed, so a task that runs again
    leaves the same files."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs
        from pyspark import TaskContext

        store, root = fs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")
        store.create_dir(root, recursive=True)
        ctx = TaskContext.get()
        enc = encoder(tokenizer)
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        seq = 0

        def flush():
            nonlocal seq, held
            doc_ids, lens, ids = (np.concatenate(x) for x in zip(*held))
            name = f"{ctx.partitionId():07d}-{seq:05d}.s8b"
            own = f"{root}/_{name}.{ctx.taskAttemptId()}"
            with store.open_output_stream(own) as out:
                out.write(to_bytes(doc_ids, lens, ids))
            store.move(own, f"{root}/{name}")
            row = [ctx.partitionId(), seq, f"{root}/{name}", len(doc_ids), len(ids)]
            held, seq = [], seq + 1
            return pa.RecordBatch.from_pylist([dict(zip(
                ("part", "seq", "file", "n_docs", "n_ids"), row))])

        n = 0
        for batch in batches:
            for b in pieces(batch, 2_000_000):
                ids, lens = enc.encode(b.column(1))
                ends = np.cumsum(lens)
                held.append((np.asarray(b.column(0).fill_null(NULL_ID)), lens + 1,
                             np.insert(ids, ends, end_id)))
                n += len(held[-1][2])
                if n >= file_ids:
                    yield flush()
                    n = 0
        if held:
            yield flush()
        release()

    ordered = (id_and_text(docs).repartitionByRange("doc_id")
               .sortWithinPartitions("doc_id", "text"))
    return ordered.mapInArrow(write, MANIFEST)


def read_tokens(manifest: DataFrame, folder: str) -> DataFrame:
    """Read the files back: per document its place in the whole stream, its
    number of ids and their checksum.  ``manifest`` has a row per file."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        forget()                       # all files are written: their units' memory is free for reading
        store, _ = fs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")
        for batch in batches:
            for row in batch.to_pylist():
                with store.open_input_file(row["file"]) as f:
                    doc_ids, lens, ids = from_bytes(f.read())
                raw = memoryview(ids.astype("<u4").tobytes())
                ends = np.cumsum(lens)
                crc = [zlib.crc32(raw[4 * (e - n):4 * e])
                       for e, n in zip(ends.tolist(), lens.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc_ids, mask=doc_ids == NULL_ID), pa.array(ends - lens + row["start"]),
                     pa.array(lens), pa.array(crc, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"])

    # a writing task's files follow each other: totals of the tasks, then places inside one
    def before(*by: str):
        return Window.partitionBy(*by).rowsBetween(Window.unboundedPreceding, -1)

    parts = manifest.groupBy("part").agg(F.sum("n_ids").alias("ids"))
    parts = parts.select("part", F.coalesce(F.sum("ids").over(before().orderBy("part")), F.lit(0)).alias("first"))
    placed = manifest.join(parts, "part").withColumn(
        "start", F.col("first") + F.coalesce(F.sum("n_ids").over(before("part").orderBy("seq")), F.lit(0)))
    # as many tasks as files, given as a number: rows of a manifest are small, and Spark
    # would merge them into one task, which then reads all files
    files = max(1, min(manifest.count(), MOST_READERS))
    return (placed.select("file", "start").repartition(files, "file")
            .mapInArrow(read, TOKENS))


def store_and_read(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    folder = job_dir(docs.sparkSession, "tokens")
    manifest = written(write_tokens(docs, f"{folder}/files", tokenizer, end_id), folder, "manifest")
    return read_tokens(manifest, f"{folder}/files")
