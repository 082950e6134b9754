import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from pulsekit.llm import word_runs
from tests.llm.conftest import frame


def brute_runs(w, least=6, times=4):
    """(start, length, period) of every run, each period by itself."""
    out = []
    for p in range(1, len(w) // times + 1):
        i = 0
        while i + p < len(w):
            j = i
            while j + p < len(w) and w[j] == w[j + p]:
                j += 1
            n = j + p - i
            if j > i and n >= max(least, times * p) and not any(
                    all(w[x] == w[x + d] for x in range(i, i + n - d)) for d in range(1, p)):
                out.append((i, n, p))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_row(doc_id, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    if doc_id is not None and w:
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0:
            g, old = h // 10, list(w)
            a = g % len(w)
            p = 1 + (len(w) - a) // (3 + g % 8)
            w = [old[i] if i < a else old[a + (i - a) % p] for i in range(len(w))]
    runs = brute_runs(w)
    drop = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None, None, None))
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest(),
            hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in drop).encode()).hexdigest())


def text_of(rnd):
    k, w = rnd.choice([1, 2, 3, 5, 50]), []
    for _ in range(rnd.randint(0, 6)):
        unit = [rnd.randrange(k) for _ in range(rnd.randint(1, rnd.choice([2, 5, 20])))]
        if rnd.random() < 0.3:
            unit = unit * rnd.randint(2, 4) + [rnd.randrange(k)]
        w += unit * rnd.randint(1, 9)
        w = w[:len(w) - rnd.randint(0, 2)] if w else w
    return w


def test_whole_documents_and_tiles_equal_brute_force():
    rnd = random.Random(2)
    for _ in range(40):
        docs = [np.array(text_of(rnd), np.int64) for _ in range(8)]
        for least, times in ((6, 4), (3, 3)):
            found = word_runs.solve_whole(docs, least, times)
            for i, w in enumerate(docs):
                want = brute_runs(w.tolist(), least, times)
                got = word_runs.smallest_only([(a, b - a + p, p) for p, a, b in found.get(i, [])])
                assert got == want, w.tolist()
                for tile_words in (16, 40):
                    parts = []
                    for first, last, begin, end in word_runs.tiles(len(w), tile_words, times):
                        parts += word_runs.solve_tile(w[begin:end], begin, first, last, len(w), least, times)
                    whole = word_runs.joined(*zip(*parts)) if parts else []
                    got = word_runs.smallest_only([(a, b - a + p, p) for p, a, b in whole
                                                   if word_runs.long_enough(p, a, b, least, times)])
                    assert got == want, (tile_words, w.tolist())


def test_hashes_that_collide_are_verified(monkeypatch):
    """With a hash of two values everything looks alike, and the words decide."""
    monkeypatch.setattr(word_runs, "splitmix", lambda x: x & np.uint64(1))
    rnd = random.Random(4)
    for _ in range(40):
        w = np.array(text_of(rnd), np.int64)
        found = word_runs.solve_whole([w], 6, 4)
        assert word_runs.smallest_only([(a, b - a + p, p) for p, a, b in found.get(0, [])]) == brute_runs(w.tolist())


def test_z_function():
    rnd = random.Random(1)
    for _ in range(100):
        s = [rnd.randrange(2) for _ in range(rnd.randint(1, 30))]
        z = word_runs.z_function(s)
        for i in range(1, len(s)):
            k = 0
            while i + k < len(s) and s[k] == s[i + k]:
                k += 1
            assert z[i] == k


def collected(df):
    cols = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


@pytest.mark.parametrize("tile_words", [16_384, 48])
def test_op12_equals_brute_force(spark, small_docs, tile_words):
    docs = small_docs.repartition(3)
    got = collected(word_runs.digests(word_runs.runs(docs, tile_words=tile_words, edit=word_runs.planted)))
    assert got == sorted((brute_row(r["doc_id"], r["text"]) for r in docs.collect()), key=repr)
    assert sum(r[1] > 0 for r in got) >= 3


@pytest.mark.parametrize("tile_words", [16_384, 32])
def test_op12_odd_rows(spark, edge_docs, no_docs, tile_words):
    rnd = random.Random(7)
    rows = [(r["doc_id"], r["text"], r["lang"]) for r in edge_docs.collect()]
    rows += [(100 + i, rnd.choice([" ", "\t\n", "\x0b\x0c "]).join(f"w{x}" for x in text_of(rnd)), "en") for i in range(40)]
    rows += [(200, "a " * 500, "en"), (200, "b " * 500, "en"), (200, "a " * 500, "en"), (None, "a b " * 300, None),
             (None, "a b " * 300, None), (201, "x y " * 40, None), (202, "é É " * 7 + "é", None),
             (203, " ".join(f"w{i % 37}" for i in range(4000)) + " end", None)]
    docs = frame(spark, rows)
    found = word_runs.runs(docs, tile_words=tile_words, edit=word_runs.planted)
    assert collected(word_runs.digests(found)) == sorted((brute_row(i, t) for i, t, _ in rows), key=repr)
    assert word_runs.digests(word_runs.runs(no_docs, edit=word_runs.planted)).collect() == []


def test_op12_very_long_text(spark):
    """Longer than a piece and than a tile, without an edit: one run to its end."""
    docs = frame(spark, [(1, " ".join(["p%d" % (i % 5000) for i in range(450_000)]), None), (2, "q " * 1_200_000, None)])
    got = {r["doc_id"]: r for r in word_runs.runs(docs).collect()}
    assert [tuple(r) for r in got[1]["runs"]] == [(0, 450_000, 5000)] and len(got[1]["collapsed"].split()) == 5000
    assert [tuple(r) for r in got[2]["runs"]] == [(0, 1_200_000, 1)] and got[2]["collapsed"] == "q"
