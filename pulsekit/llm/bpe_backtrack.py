"""Operator 10: exact BPE ids by longest tokens and backtracking, and decoding.

A piece (a pre-token of the tokenizer) is encoded from the left: an
Aho-Corasick automaton over the vocabulary gives the tokens that begin at each
position, the longest is tried first, and a token may follow another only if
the two are compatible, that is, if the merges applied to their joined text
give back just these two.  Since the encoding of every prefix is unique, a
position that failed once is never tried again, so a piece takes linear time.
Adjacent compatibility makes the whole the result of the merges.

Decoding reads token strings from one buffer by an offset table.  The file
names no decoder, for which the library joins token strings with blanks.

Documents are independent rows; a worker remembers the ids of words it met.
Empty and null texts have no ids; null doc_id and repeated rows are rows like
any others.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from pulsekit.llm.common import gather, id_and_text, pieces

END = "\n"          # stands for the word-end suffix; byte-level strings have no line feed
#: Characters on whose class engines differ: texts with them are one word.
ODD = re.compile("[\x1c-\x1f]")


class BacktrackBPE:
    """Encoder of a tokenizers file: BPE with byte-level pieces and, or not, a
    word-end suffix.  Normaliser and pre-tokenizer are the file's own."""

    def __init__(self, path: str, limit: int = 600_000):
        import ahocorasick
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        self.tok = Tokenizer.from_file(path)
        self.suffix = model["end_of_word_suffix"] or ""
        self.special = {t.content: i for i, t in self.tok.get_added_tokens_decoder().items()}
        self.split = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True))))
        self.limit = limit
        mark = (lambda t: t[:-len(self.suffix)] + END if t.endswith(self.suffix) else t) if self.suffix else (lambda t: t)
        self.vocab = {mark(t): i for t, i in model["vocab"].items() if t not in self.special}
        self.text = {i: t for t, i in self.vocab.items()}
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.rank = {(self.vocab[mark(a)], self.vocab[mark(b)]): (r, self.vocab[mark(a + b)])
                     for r, (a, b) in enumerate(merges)}
        self.tokens = ahocorasick.Automaton()
        for t, i in self.vocab.items():
            self.tokens.add_word(t, (len(t), i))
        self.tokens.make_automaton()
        strings = [""] * (1 + max(model["vocab"].values(), default=-1))
        for t, i in [*model["vocab"].items(), *self.special.items()]:
            strings += [""] * (i + 1 - len(strings))
            strings[i] = t
        raw = [s.encode() + b" " for s in strings]
        self.offset = np.concatenate([[0], np.cumsum([len(x) for x in raw])]).astype(np.int64)
        self.buffer = np.frombuffer(b"".join(raw), np.uint8)
        self.pairs: dict[tuple[int, int], bool] = {}
        self.singles: dict[int, bool] = {}
        self.forget()

    def forget(self) -> None:
        self.pieces: dict[str, list[int]] = {}
        self.codes: dict[str, int] = {}
        self.flat, self.off = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def merged(self, text: str) -> list[int]:
        """The merges one by one, lowest rank first: for pairs of tokens only."""
        atoms = list(text[:-2]) + [text[-2:]] if text.endswith(END) else list(text)
        ids = [self.vocab[a] for a in atoms]
        while len(ids) > 1:
            r, i = min((self.rank[p][0], i) if p in self.rank else (1 << 60, i)
                       for i, p in enumerate(zip(ids, ids[1:])))
            if r == 1 << 60:
                break
            ids[i:i + 2] = [self.rank[ids[i], ids[i + 1]][1]]
        return ids

    def fits(self, a: int | None, b: int) -> bool:
        """Whether b may follow a; with no a, whether b encodes itself."""
        if a is None:
            if b not in self.singles:
                self.singles[b] = self.merged(self.text[b]) == [b]
            return self.singles[b]
        ok = self.pairs.get((a, b))
        if ok is None:
            ok = self.pairs[a, b] = self.merged(self.text[a] + self.text[b]) == [a, b]
        return ok

    def encode_piece(self, piece: str) -> list[int]:
        s = piece + END if self.suffix else piece
        n = len(s)
        at: list[list[tuple[int, int]]] = [[] for _ in range(n)]
        for end, token in self.tokens.iter(s):
            at[end + 1 - token[0]].append(token)          # ascending length
        dead = bytearray(n + 1)
        path: list[tuple[int, int, int]] = []             # token, its place, next choice there
        pos, k, last = 0, len(at[0]) - 1, None
        while pos < n:
            while k >= 0:
                size, token = at[pos][k]
                k -= 1
                if not dead[pos + size] and self.fits(last, token):
                    path.append((token, pos, k))
                    pos, last = pos + size, token
                    k = len(at[pos]) - 1 if pos < n else -1
                    break
            else:
                dead[pos] = 1
                if not path:
                    raise ValueError("the vocabulary can't spell this text")
                _, pos, k = path.pop()
                last = path[-1][0] if path else None
        return [t for t, _, _ in path]

    def of_piece(self, piece: str) -> list[int]:
        ids = self.pieces.get(piece)
        if ids is None:
            ids = self.pieces[piece] = self.encode_piece(piece)
        return ids

    def of_text(self, text: str) -> list[int]:
        """ids of any stretch of text by the file's own steps."""
        out: list[int] = []
        at = 0
        for m in [*self.split.finditer(text), None] if self.special else [None]:
            part = text[at:m.start()] if m else text[at:]
            if part:
                norm = self.tok.normalizer.normalize_str(part) if self.tok.normalizer else part
                for piece, _ in self.tok.pre_tokenizer.pre_tokenize_str(norm):
                    out += self.of_piece(piece)
            if m:
                out.append(self.special[m[0]])
                at = m.end()
        return out

    def words(self, text: str) -> list[str]:
        """Stretches that are encoded apart: with a word-end suffix, and white
        space dropped, runs of non-space; else the text."""
        return text.split() if self.suffix and not ODD.search(text) else [text] * bool(text)

    def learn(self, words: list[str]) -> None:
        """ids of new words; the file's steps run once over many plain words."""
        ids: dict[str, list[int]] = {}
        plain = [w for w in words if self.suffix and not ODD.search(w) and not self.split.search(w)]
        for lo in range(0, len(plain), 2000):
            run = plain[lo:lo + 2000]
            norm = self.tok.normalizer.normalize_str(" ".join(run))
            sizes = [len(w) for w in norm.split(" ")]
            if len(sizes) != len(run):
                continue                                  # one by one below
            ends = np.cumsum(np.array(sizes) + 1).tolist()
            lists: list[list[int]] = [[] for _ in run]
            i = 0
            for piece, (start, _) in self.tok.pre_tokenizer.pre_tokenize_str(norm):
                while start >= ends[i]:
                    i += 1
                lists[i] += self.of_piece(piece)
            ids.update(zip(run, lists))
        lists = [ids[w] if w in ids else self.of_text(w) for w in words]
        base = len(self.off) - 1
        self.codes.update(zip(words, range(base, base + len(words))))
        lens = np.fromiter(map(len, lists), np.int64, len(lists))
        self.flat = np.concatenate([self.flat, np.fromiter((i for x in lists for i in x), np.uint32, int(lens.sum()))])
        self.off = np.concatenate([self.off, self.off[-1] + np.cumsum(lens)])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, number of ids of each text)."""
        if len(self.codes) > self.limit:
            self.forget()
        words: list[str] = []
        ends = []
        for t in texts:
            words += self.words(t)
            ends.append(len(words))
        get = self.codes.get
        codes = np.fromiter((get(w, -1) for w in words), np.int64, len(words))
        missing = np.flatnonzero(codes < 0).tolist()
        if missing:
            self.learn(list(dict.fromkeys(words[i] for i in missing)))
            codes[missing] = [self.codes[words[i]] for i in missing]
        lens = self.off[codes + 1] - self.off[codes]
        ids = self.flat[gather(self.off[codes], lens)]
        sums = np.concatenate([[0], np.cumsum(lens)])
        return ids, np.diff(np.concatenate([[0], sums[ends]]) if ends else np.zeros(1, np.int64))

    def decode(self, ids: np.ndarray, lens: np.ndarray) -> list[memoryview]:
        """The texts' bytes: token strings with a blank between them."""
        size = (self.offset[1:] - self.offset[:-1])[ids]
        raw = memoryview(self.buffer[gather(self.offset[ids], size)].tobytes())
        sums = np.concatenate([[0], np.cumsum(size)])
        ends = np.concatenate([[0], np.cumsum(lens)])
        return [raw[lo:max(lo, hi - 1)] for lo, hi in zip(sums[ends[:-1]].tolist(), sums[ends[1:]].tolist())]


_CODERS: dict[str, BacktrackBPE] = {}


def coder(path: str) -> BacktrackBPE:
    """The worker's coder of a tokenizer file, kept between tasks."""
    if path not in _CODERS:
        _CODERS[path] = BacktrackBPE(path)
    return _CODERS[path]


def encode_documents(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, ids array<int> and the decoded text of every row."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = coder(tokenizer)
        for batch in batches:
            for b in pieces(batch, 1_000_000):
                ids, lens = c.encode(b.column(1).to_pylist())
                off = pa.array(np.concatenate([[0], np.cumsum(lens)]).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.ListArray.from_arrays(off, pa.array(ids.astype(np.int32))),
                     pa.array([str(x, "utf-8") for x in c.decode(ids, lens)], pa.string())],
                    names=["doc_id", "ids", "decoded"])

    return id_and_text(docs).mapInArrow(work, "doc_id long, ids array<int>, decoded string")


def digests(docs: DataFrame, tokenizer: str) -> DataFrame:
    """As ``encode_documents``, with checksums in place of ids and texts, taken
    where they are made: they don't travel."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = coder(tokenizer)
        for batch in batches:
            for b in pieces(batch, 2_000_000):
                ids, lens = c.encode(b.column(1).to_pylist())
                raw = memoryview(ids.astype("<u4").tobytes())
                ends = np.concatenate([[0], np.cumsum(lens)]).tolist()
                sha = [hashlib.sha256(raw[4 * lo:4 * hi]).hexdigest() for lo, hi in zip(ends, ends[1:])]
                out = [hashlib.sha256(x).hexdigest() for x in c.decode(ids, lens)]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array(lens), pa.array(sha), pa.array(out)],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return id_and_text(docs).mapInArrow(
        work, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
