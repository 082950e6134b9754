"""Whole-text encoding with a library tokenizer, one call per distinct unit.

A unit is a stretch of text that the tokenizer never merges across: for the
byte-level pre-tokenizer a run of non-space characters with the one blank
before it, or a line feed; for the word-end pre-tokenizer, which drops white
space, a run of non-space characters.  A worker keeps the ids of the units it
has met, so the library sees each of them once; a text with other white space
(runs of blanks, tabs, no-break spaces, control characters) or with one of the
tokenizer's special strings is given to the library whole.
"""

from __future__ import annotations

import os
import re
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from pulsekit.llm.common import release

#: Characters on whose class engines differ: texts with them go to the library whole.
ODD = re.compile("[\u0085᠎​⁠﻿\x1c-\x1f]")

#: Units that the library is given at once, parted by line feeds.
RUN = 64


def byte_units(texts: pa.Array) -> pa.Array:
    """The units of every text, split by Arrow: no string object is made of them."""
    parted = pc.replace_substring(pc.replace_substring(texts, " ", "\0 "), "\n", "\0\n\0")
    return pc.split_pattern(parted, "\0")


def load(path: str):
    """A file's tokenizer without truncation and padding, in one thread: Spark
    gives a task one core, and threads of the library keep memory of their own."""
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    return tok


def strings(units: pa.Array) -> list[str]:
    """A list of them, made by one split: an object a unit takes Arrow far longer."""
    if not len(units):
        return []
    whole = pa.ListArray.from_arrays([0, len(units)], units)
    return pc.binary_join(whole, pa.scalar("\0", units.type))[0].as_py().split("\0")


def grown(a: np.ndarray, size: int) -> np.ndarray:
    if size <= len(a):
        return a
    b = np.empty(max(size, 3 * len(a) // 2), a.dtype)
    b[:len(a)] = a
    return b


class UnitEncoder:
    """ids of whole texts.  A worker remembers units with their ids, end to end in
    arrays that grow by halves (``off`` counts bytes), and when it last met them; beyond twice ``limit``
    units, the ``limit`` that it met last stay.  Code 0 is the line feed; units that
    may not be encoded by themselves are ``odd`` and have no ids."""

    def __init__(self, path: str, limit: int = 500_000):
        self.tok = load(path)
        self.specials = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.limit = limit
        (self.feed,) = self.tok.encode("\n", add_special_tokens=False).ids
        self.codes: dict[str, int] = {"\n": 0}             # in the order of the codes
        self.flat, self.off = np.array([self.feed], np.uint32), np.array([0, 4])
        self.last, self.odd = np.zeros(1, np.int64), np.zeros(1, bool)
        self.clock = 0

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tok.encode(text, add_special_tokens=False).ids, np.uint32)

    def regular(self, units: list[str]) -> bool:
        """Whether all of them are words, with a blank before or not, that may be
        encoded by themselves."""
        joined = "\n".join(units)
        return (joined.split() == [u[1:] if u[:1] == " " else u for u in units]
                and not ODD.search(joined) and not any(s in joined for s in self.specials))

    def forget_old(self) -> None:
        """Only the line feed and the ``limit`` units met last stay."""
        known = len(self.codes)
        self.last[0] = self.clock + 1
        stay = np.sort(np.argpartition(self.last[:known], known - self.limit - 1)[known - self.limit - 1:])
        ids, off = self.ids_of(stay)
        units = list(self.codes)
        self.codes = {units[i]: k for k, i in enumerate(stay.tolist())}
        self.flat, self.off = ids.copy(), off.copy()
        self.last, self.odd = self.last[stay], self.odd[stay]

    def ids_of(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(the units' ids end to end, where each begins and the last ends, in bytes)."""
        known = pa.Array.from_buffers(pa.large_binary(), len(self.codes),
                                      [None, pa.py_buffer(self.off), pa.py_buffer(self.flat)])
        _, off, ids = known.take(pa.array(codes)).buffers()
        off = np.frombuffer(off, np.int64, len(codes) + 1) if len(codes) else np.zeros(1, np.int64)
        return (np.frombuffer(ids, np.uint32, off[-1] // 4) if off[-1] else np.zeros(0, np.uint32)), off

    def learn(self, units: list[str]) -> np.ndarray:
        """The codes of units that are not known yet."""
        odd = np.zeros(len(units), bool)
        for i in range(0, len(units), RUN):
            if not self.regular(units[i:i + RUN]):
                odd[i:i + RUN] = [not self.regular([u]) for u in units[i:i + RUN]]
        good = [u for u, o in zip(units, odd.tolist()) if not o] if odd.any() else units
        # one call for many units: line feeds part them and are ids of their own
        runs = ["\n".join(good[i:i + RUN]) for i in range(0, len(good), RUN)]
        ids = np.concatenate([np.zeros(0, np.uint32)] + [
            np.array([*e.ids, self.feed], np.uint32)
            for e in self.tok.encode_batch_fast(runs, add_special_tokens=False)])
        ends = np.flatnonzero(ids == self.feed)
        ids = ids[ids != self.feed]
        lens = np.zeros(len(units), np.int64)
        lens[~odd] = np.diff(ends - np.arange(len(ends)), prepend=0)
        known = len(self.codes)
        more, end = known + len(units), int(self.off[known]) // 4
        self.flat, self.off = grown(self.flat, end + len(ids)), grown(self.off, more + 1)
        self.last, self.odd = grown(self.last, more), grown(self.odd, more)
        self.flat[end:end + len(ids)] = ids
        self.off[known + 1:more + 1] = 4 * (end + np.cumsum(lens))
        self.odd[known:more] = odd
        self.codes.update(zip(units, range(known, more)))
        return np.arange(known, more)

    def encode(self, texts: pa.Array | list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, number of ids of each text), of texts that are not null."""
        if len(self.codes) > 2 * self.limit:
            self.forget_old()
        if not isinstance(texts, pa.Array):
            texts = pa.array(texts, pa.string())
        texts = texts.cast(pa.large_string())          # units may be longer than their texts
        lists = byte_units(texts)
        ends = np.asarray(lists.offsets)[1:].astype(np.int64)
        table = lists.values.dictionary_encode()
        units = strings(table.dictionary)              # each unit once, in order of its first place
        codes = np.fromiter(map(self.codes.get, units, repeat(-1)), np.int64, len(units))
        missing = np.flatnonzero(codes < 0)
        if len(missing):
            codes[missing] = self.learn([units[i] for i in missing.tolist()])
        self.clock += 1
        self.last[codes] = self.clock
        some_odd = self.odd[codes].any()
        codes = codes[np.asarray(table.indices)]
        alone = set(np.flatnonzero(np.asarray(pc.match_substring(texts, "\0"))).tolist())
        if some_odd:
            alone.update(np.searchsorted(ends, np.flatnonzero(self.odd[codes]), side="right").tolist())
        ids, off = self.ids_of(codes)
        bounds = np.concatenate([[0], off[ends] // 4])
        if not alone:
            return ids, np.diff(bounds)
        parts = [self.whole(texts[i].as_py()) if i in alone else ids[bounds[i]:bounds[i + 1]]
                 for i in range(len(texts))]
        return np.concatenate(parts), np.fromiter(map(len, parts), np.int64, len(parts))


_ENCODERS: dict[tuple[str, int], UnitEncoder] = {}


def encoder(path: str, limit: int = 500_000) -> UnitEncoder:
    """The worker's encoder of a tokenizer file, kept between tasks with the units
    it knows."""
    key = (path, limit)
    if key not in _ENCODERS:
        _ENCODERS[key] = UnitEncoder(path, limit)
    return _ENCODERS[key]


def forget() -> None:
    """Drop the worker's encoders, when a job has encoded its last text."""
    _ENCODERS.clear()
    release()
