"""Operators 3, 6, 9 and 10 against the tokenizers library, text by text."""

import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from pulsekit.llm import bin_packing, bpe_backtrack, token_counts, token_store
from pulsekit.llm.units import UnitEncoder

BYTE = public_tokenizers.path("byte_bpe_50k.json")
WORD = public_tokenizers.path("word_bpe_49k.json")


def ids_of(path, texts):
    return [e.ids for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]


def raw(ids):
    return np.array(ids, "<u4").tobytes()


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def pairs(docs):
    return [(r["doc_id"], r["text"] or "") for r in docs.select("doc_id", "text").collect()]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 70), st.integers(0, 60000), st.integers(0, 2**64 - 1)), max_size=300),
       st.sampled_from([1, 7, 64, 2048]))
def test_simple8b_round_trip(ids, block):
    a = np.array(ids, np.uint64)
    words, starts = token_store.pack(a, block)
    assert len(starts) == -(-len(ids) // block) + 1
    assert token_store.unpack(words, starts, len(a), block).tolist() == ids


def test_simple8b_uses_the_widths():
    words, _ = token_store.pack(np.ones(60, np.uint64))
    assert len(words) == 1
    words, _ = token_store.pack(np.full(6, 1000, np.uint64))
    assert len(words) == 1
    words, _ = token_store.pack(np.array([2**60], np.uint64))
    assert len(words) == 2


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=4))
def test_unit_encoder_is_the_library(texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    ids, lens = UnitEncoder(BYTE).encode(texts)
    want = ids_of(BYTE, texts)
    assert lens.tolist() == [len(x) for x in want]
    assert ids.tolist() == [i for x in want for i in x]


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=4))
def test_backtracking_is_the_library(texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    c = bpe_backtrack.coder(WORD)
    ids, lens = c.encode(texts)
    want = ids_of(WORD, texts)
    assert lens.tolist() == [len(x) for x in want]
    assert ids.tolist() == [i for x in want for i in x]
    tok = Tokenizer.from_file(WORD)
    assert [str(x, "utf-8") for x in c.decode(ids, lens)] == [tok.decode(x, skip_special_tokens=False) for x in want]


@settings(max_examples=40, deadline=None)
@given(st.text(alphabet="abeinorst", min_size=1, max_size=200))
def test_backtracking_on_runs_of_letters(text):
    for path in (WORD, BYTE):
        assert bpe_backtrack.coder(path).encode([text])[0].tolist() == ids_of(path, [text])[0]


@pytest.mark.parametrize("name", ["edge_docs", "small_docs"])
def test_op3(name, request):
    docs = request.getfixturevalue(name)
    data = sorted(pairs(docs), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    want, start = [], 0
    for (doc, _), ids in zip(data, ids_of(BYTE, [t for _, t in data])):
        ids = [*ids, 2]
        want.append((doc, start, len(ids), zlib.crc32(raw(ids))))
        start += len(ids)
    assert rows(token_store.store_and_read(docs, BYTE, 2)) == sorted(want, key=repr)


@pytest.mark.parametrize("name", ["edge_docs", "small_docs"])
@pytest.mark.parametrize("block", [1, 48_000_000])
def test_op6(name, block, request):
    docs = request.getfixturevalue(name)
    if block == 1 and name == "small_docs":
        docs = docs.where("doc_id < 30")
    data = pairs(docs)
    want = [(d, len(t.encode()), len(i), len(i) > 2048) for (d, t), i in zip(data, ids_of(WORD, [t for _, t in data]))]
    got = token_counts.over_limit(token_counts.count_tokens(docs, WORD, block), 2048)
    assert rows(got) == sorted(want, key=repr)


@pytest.mark.parametrize("name", ["edge_docs", "small_docs"])
def test_op10(name, request):
    docs = request.getfixturevalue(name)
    data, tok = pairs(docs), Tokenizer.from_file(WORD)
    want = [(d, len(i), hashlib.sha256(raw(i)).hexdigest(),
             hashlib.sha256(tok.decode(i, skip_special_tokens=False).encode()).hexdigest())
            for (d, _), i in zip(data, ids_of(WORD, [t for _, t in data]))]
    assert rows(bpe_backtrack.digests(docs, WORD)) == sorted(want, key=repr)
    full = {r["doc_id"]: r["ids"] for r in bpe_backtrack.encode_documents(docs, WORD).collect()}
    assert all(full[d] == i for (d, _), i in zip(data, ids_of(WORD, [t for _, t in data])))


@pytest.mark.parametrize("name", ["edge_docs", "small_docs"])
@pytest.mark.parametrize("capacity", [16, 2048])
def test_op9(name, capacity, request):
    docs = request.getfixturevalue(name)
    data = pairs(docs)
    want = []
    for (d, _), ids in zip(data, ids_of(BYTE, [t for _, t in data])):
        ids = [*ids, 0]
        cut = len(ids) % capacity or capacity
        edges = [0, *range(min(cut, len(ids)), len(ids), capacity), len(ids)]
        want += [(d, k, a, b - a, zlib.crc32(raw(ids[a:b]))) for k, (a, b) in enumerate(zip(edges, edges[1:]))]
    got = bin_packing.pack_documents(docs, BYTE, 0, capacity).collect()
    assert sorted((tuple(r)[:5] for r in got), key=repr) == sorted(want, key=repr)
    bins = {}
    for r in got:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    histogram = {}
    for w in want:
        histogram[w[3]] = histogram.get(w[3], 0) + 1
    assert len(bins) <= sum(n for _, n in bin_packing.best_fit(histogram, capacity))
    assert len(bins) >= bin_packing.lower_bound(histogram, capacity)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=40), st.integers(40, 60))
def test_bins_hold_everything_and_beat_best_fit(lengths, capacity):
    h = {n: lengths.count(n) for n in lengths}
    plan = bin_packing.complete_bins(h, capacity)
    held = {}
    for pattern, times in plan:
        assert sum(pattern) <= capacity
        for n in pattern:
            held[n] = held.get(n, 0) + times
    assert held == h
    used = sum(t for _, t in plan)
    assert bin_packing.lower_bound(h, capacity) <= used <= sum(t for _, t in bin_packing.best_fit(h, capacity))


def test_bins_find_the_optimum_that_best_fit_misses():
    h = {6: 2, 5: 2, 4: 2, 3: 2, 2: 2}                      # two full sequences of 20
    assert sum(t for _, t in bin_packing.complete_bins(h, 20)) == 2
    with pytest.raises(ValueError):
        bin_packing.complete_bins({30: 1}, 20)


def test_no_rows(no_docs):
    assert token_store.store_and_read(no_docs, BYTE, 2).collect() == []
    assert token_counts.count_tokens(no_docs, WORD).collect() == []
    assert bin_packing.pack_documents(no_docs, BYTE, 0).collect() == []
    assert bpe_backtrack.digests(no_docs, WORD).collect() == []


def test_units_met_last_are_not_learned_again(monkeypatch):
    enc, learned = UnitEncoder(BYTE, limit=3), []
    learn = enc.learn
    monkeypatch.setattr(enc, "learn", lambda units: learned.extend(units) or learn(units))
    for k in range(8):
        texts = [f"often{'' if k else ' also'} new{k} other{k}"]
        ids, lens = enc.encode(texts)
        assert (ids.tolist(), lens.tolist()) == (ids_of(BYTE, texts)[0], [len(ids)])
    assert learned.count("often") == 1 and len(enc.codes) <= 9
