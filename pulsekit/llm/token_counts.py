"""Operator 6: token counts without token ids.

A pre-token here is a run of non-space characters: the tokenizer drops white
space, so it never merges across one, and a text's tokens are those of its
pre-tokens.  Documents are read in blocks; a block gives its distinct
pre-tokens and its documents' pre-token frequencies.  Pre-tokens meet by a
shuffle, where the library counts the pieces of each distinct one once; the
counts go back to the blocks that asked and are joined to their frequencies.
What moves is a row per block and distinct pre-token (a frequent word is one
row of a block, however often it stands there) and the packed frequencies.

Texts with control characters on which engines' idea of white space differs
are one pre-token.  Empty texts have none and count 0; null doc_id and repeated
rows are rows like any others.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401 - pa.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsekit.llm.common import id_and_text, pieces, release
from pulsekit.llm.units import load

ODD = re.compile("[\x1c-\x1f]")
COUNTS = "doc_id long, n_bytes long, n_tokens long"


_LOADED: dict[str, object] = {}


def loaded(path: str):
    """The worker's tokenizer of a file, kept between tasks."""
    if path not in _LOADED:
        _LOADED[path] = load(path)
    return _LOADED[path]


def words_of(text: str) -> list[str]:
    return [text] if ODD.search(text) else text.split()


def pack_ints(x: np.ndarray) -> bytes:
    """Small numbers by byte planes, compressed."""
    x = np.ascontiguousarray(x, "<u4")
    return zlib.compress(x.view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def unpack_ints(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64)


def read_blocks(docs: DataFrame, block_bytes: int, schema: str, rows) -> DataFrame:
    """``rows`` of every block of about ``block_bytes`` of text.  A block's name
    holds a checksum of its texts, so that a block read again from rows that came
    in another order can't be taken for the same."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        held: list[pa.RecordBatch] = []
        size, seq = 0, 0

        def name() -> str:
            crc = n = 0
            for b in held:
                n += b.num_rows
                for t in b.column(1).cast(pa.binary()):
                    crc = zlib.crc32(t.as_buffer(), crc)
            return f"{part}-{seq}-{crc}-{n}"

        for batch in batches:
            for b in pieces(batch, min(block_bytes, 2_000_000)):
                held.append(b)
                size += b.nbytes
                if size >= block_bytes:
                    yield from rows(name(), held)
                    held, size, seq = [], 0, seq + 1
                    release()
        if held:
            yield from rows(name(), held)
        held = []
        release()

    return id_and_text(docs).mapInArrow(work, schema)


def vocabulary(name: str, held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(block, pos, word): the block's distinct pre-tokens, numbered as they come."""
    seen: dict[str, None] = {}
    for b in held:
        for text in b.column(1).to_pylist():
            seen.update(dict.fromkeys(words_of(text)))
    words = list(seen)
    del seen
    for lo in range(0, len(words), 20_000):
        w = words[lo:lo + 20_000]
        yield pa.RecordBatch.from_arrays(
            [pa.array([name] * len(w)), pa.array(np.arange(lo, lo + len(w), dtype=np.int32)), pa.array(w)],
            names=["block", "pos", "word"])


def frequencies(name: str, held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row: the block's documents and, packed, how often each holds which
    pre-token, by the numbers that ``vocabulary`` gives them."""
    ids: list[int | None] = []
    n_bytes, ends, deltas, freq = [], [], [], []
    pos: dict[str, int] = {}
    for b in held:
        ids += b.column(0).to_pylist()
        n_bytes += pa.compute.binary_length(b.column(1)).to_pylist()
        for text in b.column(1).to_pylist():
            codes = np.array([pos.setdefault(w, len(pos)) for w in words_of(text)], np.int32)
            own, n = np.unique(codes, return_counts=True)
            ends.append(len(own))
            deltas.append(np.diff(own, prepend=np.int32(0)))
            freq.append(n.astype(np.int32))
    del pos
    blob = [pack_ints(x) for x in (n_bytes, ends, np.concatenate(deltas), np.concatenate(freq))]
    del deltas, freq
    yield pa.RecordBatch.from_arrays(
        [pa.array([name]), pa.array([ids], pa.list_(pa.int64())), pa.array([blob], pa.list_(pa.binary()))],
        names=["block", "doc_ids", "freqs"])


def count_tokens(docs: DataFrame, tokenizer: str, block_bytes: int = 16_000_000) -> DataFrame:
    """doc_id, n_bytes (UTF-8) and n_tokens of every row."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = loaded(tokenizer)
        last, last_n = None, 0
        out: dict[str, list[np.ndarray]] = {}
        held = 0

        def flush():
            rows = [(k, *(pack_ints(np.concatenate(x)) for x in zip(*v))) for k, v in out.items()]
            for lo in range(0, len(rows), 64):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in zip(*rows[lo:lo + 64])], names=["block", "at", "n"])

        for b in batches:           # sorted by word: equal words are neighbours
            words = b.column(2).dictionary_encode()
            new = words.dictionary.to_pylist()
            own = new[1:] if new[0] == last else new
            n = np.array([len(e.ids) for lo in range(0, len(own), 1000) for e in tok.encode_batch_fast(
                own[lo:lo + 1000], add_special_tokens=False)], np.int64)
            if new[0] == last:
                n = np.concatenate([[last_n], n])
            last, last_n = new[-1], int(n[-1])
            code = b.column(0).dictionary_encode()
            names, code = code.dictionary.to_pylist(), np.asarray(code.indices)
            n, pos = n[np.asarray(words.indices)], np.asarray(b.column(1))
            order = np.argsort(code, kind="stable")
            cuts = np.searchsorted(code[order], np.arange(len(names) + 1))
            for name, lo, hi in zip(names, cuts[:-1].tolist(), cuts[1:].tolist()):
                out.setdefault(name, []).append((pos[order[lo:hi]], n[order[lo:hi]]))
            held += len(pos)
            if held > 2_000_000:
                yield from flush()
                out, held = {}, 0
        yield from flush()
        out = {}
        release()

    def total(key, left: pa.Table, right: pa.Table) -> pa.Table:
        if left.num_rows != 1:
            raise ValueError("a block changed between two reads of the same table")
        doc_ids, blob = left.column("doc_ids")[0].values, left.column("freqs")[0].as_py()
        n_bytes, ends, deltas, freq = map(unpack_ints, blob)
        at = [unpack_ints(x.as_py()) for x in right.column("at")]
        n_of = np.zeros(1 + max((int(x.max()) for x in at), default=-1), np.int64)
        for x, n in zip(at, right.column("n")):
            n_of[x] = unpack_ints(n.as_py())
        doc = np.repeat(np.arange(len(ends)), ends)
        run = np.cumsum(deltas)
        first = np.cumsum(ends) - ends
        base = np.concatenate([[0], run])[first]         # every document's deltas begin at 0
        idx = run - base[doc]
        totals = np.bincount(doc, weights=n_of[idx] * freq, minlength=len(ends)).astype(np.int64)
        return pa.table({"doc_id": doc_ids, "n_bytes": n_bytes, "n_tokens": totals})

    words = read_blocks(docs, block_bytes, "block string, pos int, word string", vocabulary)
    counted = (words.repartition("word").sortWithinPartitions("word")
               .mapInArrow(count, "block string, at binary, n binary"))
    freqs = read_blocks(docs, block_bytes, "block string, doc_ids array<long>, freqs array<binary>", frequencies)
    return freqs.groupBy("block").cogroup(counted.groupBy("block")).applyInArrow(total, COUNTS)


def over_limit(counts: DataFrame, limit: int) -> DataFrame:
    return counts.withColumn("over_limit", F.col("n_tokens") > limit)
