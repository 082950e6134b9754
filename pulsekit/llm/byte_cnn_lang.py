"""Operator 2: language identification by a byte convolutional network.

A text's UTF-8 bytes are cut into windows of ``window`` bytes (the last one
padded with zeros, which activate nothing).  Filters of several widths slide
over a window; each filter's largest activation is kept, and a softmax layer
turns them into language probabilities.  A text's score is the mean over its
windows.  The filters' weights are kept per byte and place in the filter, so a
convolution is a sum of table rows, and windows of many texts go through
together.

Training (numpy, on the driver) takes at most ``docs_per_lang`` texts of a
language, chosen by a hash of their ids and texts, of at most ``most_langs`` languages, and at most ``windows_per_doc`` windows
of each; all three bounds are parameters.  Prediction reads nothing but the text.

Texts that are null or have no letter get ``und`` with score 0; so do all
texts when no row is labelled.  Null doc_id and repeated rows are rows like any
others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsekit.session import ship
from pulsekit.llm.common import NULL_ID, free_name, pieces, release

WIDTHS = (2, 3, 4, 5)


class ByteCNN:
    """``tables[k]``: for the k-th byte under a filter, a row of weights per byte
    value, for those filters that are wider than k (the wide ones first)."""

    def __init__(self, classes: list[str], filters: int = 12, window: int = 256, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.classes, self.window = classes, window
        self.sizes = [filters * sum(w > k for w in WIDTHS) for k in range(max(WIDTHS))]
        self.tables = [rng.normal(0, 0.3, (256, n)).astype(np.float32) for n in self.sizes]
        for t in self.tables:
            t[0] = 0
        self.bias = np.zeros(self.sizes[0], np.float32)
        self.out = rng.normal(0, 0.1, (self.sizes[0], len(classes))).astype(np.float32)
        self.out_bias = np.zeros(len(classes), np.float32)

    def windows(self, text: bytes) -> np.ndarray:
        """All of the text, a row of ``window`` bytes at a time."""
        n = -(-len(text) // self.window)
        x = np.zeros(n * self.window, np.uint8)
        x[:len(text)] = np.frombuffer(text, np.uint8)
        return x.reshape(n, self.window)

    def convolve(self, x: np.ndarray) -> np.ndarray:
        padded = np.concatenate([x, np.zeros((len(x), max(WIDTHS) - 1), np.uint8)], axis=1)
        y = self.tables[0][padded[:, :self.window]]
        for k, table in enumerate(self.tables[1:], 1):
            y[:, :, :self.sizes[k]] += table[padded[:, k:k + self.window]]
        return y

    def pooled(self, x: np.ndarray) -> np.ndarray:
        return np.maximum(self.convolve(x).max(axis=1) + self.bias, 0)

    def probabilities(self, x: np.ndarray, step: int = 32) -> np.ndarray:
        """Of every window; a few windows at a time stay in the cache."""
        out = np.empty((len(x), len(self.classes)), np.float32)
        for lo in range(0, len(x), step):
            z = self.pooled(x[lo:lo + step]) @ self.out + self.out_bias
            z = np.exp(z - z.max(axis=1, keepdims=True))
            out[lo:lo + step] = z / z.sum(axis=1, keepdims=True)
        return out

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = 4, batch: int = 64,
            rate: float = 0.01, seed: int = 11) -> None:
        """Adam on the cross entropy; a pooled activation passes its gradient to
        the bytes under its largest place only."""
        rng = np.random.default_rng(seed)
        params = [*self.tables, self.bias, self.out, self.out_bias]
        first = [np.zeros_like(p) for p in params]
        second = [np.zeros_like(p) for p in params]
        step = 0
        for _ in range(epochs):
            order = rng.permutation(len(x))
            for lo in range(0, len(x), batch):
                rows = order[lo:lo + batch]
                xb = x[rows]
                conv = self.convolve(xb)
                place = conv.argmax(axis=1)
                top = np.take_along_axis(conv, place[:, None, :], axis=1)[:, 0] + self.bias
                hidden = np.maximum(top, 0)
                z = hidden @ self.out + self.out_bias
                z = np.exp(z - z.max(axis=1, keepdims=True))
                err = z / z.sum(axis=1, keepdims=True)
                err[np.arange(len(rows)), y[rows]] -= 1
                err /= len(rows)
                back = (err @ self.out.T) * (top > 0)
                padded = np.concatenate([xb, np.zeros((len(xb), max(WIDTHS) - 1), np.uint8)], axis=1)
                grads = []
                for k, n in enumerate(self.sizes):
                    g = np.zeros_like(self.tables[k])
                    seen = np.take_along_axis(padded, place[:, :n] + k, axis=1)
                    np.add.at(g, (seen, np.arange(n)[None, :]), back[:, :n])
                    g[0] = 0
                    grads.append(g)
                grads += [back.sum(axis=0), hidden.T @ err, err.sum(axis=0)]
                step += 1
                for p, g, m, v in zip(params, grads, first, second):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    p -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, trainable, docs_per_lang: int = 600, windows_per_doc: int = 6,
          window: int = 256, seed: int = 7, most_langs: int = 1000) -> ByteCNN | None:
    """A network for the languages of the ``trainable`` rows, the ``most_langs`` most
    frequent if there are more; about docs_per_lang rows of each language are drawn by a
    hash of doc_id and text, so that rows of one doc_id, or of none, are drawn one by one.
    Equal windows of equal rows count once.  A language none of whose rows is drawn (a
    few texts, many times) is learned from the text of its smallest hash.  At most
    docs_per_lang x windows_per_doc windows of a language are used,
    those of a language with fewer as often as the others'."""
    ship(docs.sparkSession)
    pick = F.pmod(F.xxhash64(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)),
                             F.col("text").cast("string"), F.lit(seed)), F.lit(1 << 20))
    rows = docs.where(trainable).select(
        pick.alias("pick"), F.col("text").cast("string").alias("text"),
        F.col("lang").cast("string").alias("lang")).where("text is not null and lang is not null")
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n"))
              .orderBy(F.desc("n"), "lang").limit(most_langs).collect()}
    if not counts:
        return None
    shares = docs.sparkSession.createDataFrame(
        [(lang, int(min(1.0, 1.2 * docs_per_lang / n) * (1 << 20))) for lang, n in counts.items()],
        "lang string, share long")                      # at most most_langs rows
    chosen = rows.join(F.broadcast(shares), "lang").where("pick < share").select("pick", "text", "lang")

    def some_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, out = [], []
            for i, text in enumerate(b.column(1).to_pylist()):
                raw = text.encode()
                n = max(1, -(-len(raw) // window))
                for k in sorted({n * j // windows_per_doc for j in range(windows_per_doc)}):
                    rows.append(i)
                    out.append(raw[k * window:(k + 1) * window])
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(rows, pa.int64())), b.column(2).take(pa.array(rows, pa.int64())),
                 pa.array(out, pa.binary())], names=["pick", "lang", "window"])

    def windows_of(texts: DataFrame) -> pd.DataFrame:
        found = texts.mapInArrow(some_windows, "pick long, lang string, window binary").distinct()
        return found.orderBy("pick", "lang", "window").limit(2 * docs_per_lang * windows_per_doc * len(counts)).toPandas()

    sample = windows_of(chosen)
    rest = sorted(set(counts) - set(sample["lang"]))
    if rest:
        one = (rows.join(F.broadcast(shares.where(F.col("lang").isin(rest))), "lang")
               .groupBy("lang").agg(F.min_by("text", "pick").alias("text")))
        sample = pd.concat([sample, windows_of(one.select(F.lit(0).cast("long").alias("pick"), "text", "lang"))])
    classes = sorted(counts)
    model = ByteCNN(classes, window=window, seed=seed)
    sample = sample.sort_values(["lang", "window", "pick"])      # the same network whatever the order of rows
    sample = sample.groupby("lang").sample(frac=1, random_state=seed).groupby("lang").head(docs_per_lang * windows_per_doc)
    # a language of few different windows is shown as often as the others
    most = sample.groupby("lang").size().max()
    sample = pd.concat([g.iloc[np.resize(np.arange(len(g)), most)] for _, g in sample.groupby("lang")])
    x = np.concatenate([np.zeros((0, window), np.uint8)] + [
        model.windows(bytes(w)) if len(w) else np.zeros((1, window), np.uint8) for w in sample["window"]])
    model.fit(x, np.searchsorted(classes, sample["lang"].to_numpy()))
    return model


def carried_names(docs: DataFrame) -> list[str]:
    """Names of the two columns that ``predict`` puts beside those of ``docs``."""
    return [free_name(docs, "__lang_pred"), free_name(docs, "__score")]


def predict(docs: DataFrame, model: ByteCNN | None, carry: bool = False) -> DataFrame:
    """doc_id, lang_pred and score of every row; with ``carry``, the rows
    themselves with these as the columns ``carried_names``."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in pieces(batch, 2_000_000, whole):
                texts = b.column(0).to_pylist()
                known = [t is not None and any(map(str.isalpha, t)) and model is not None for t in texts]
                lang = ["und"] * len(texts)
                score = [0.0] * len(texts)
                rows = [i for i, k in enumerate(known) if k]
                if rows:
                    x = [model.windows(texts[i].encode()) for i in rows]
                    n = np.array([len(v) for v in x])
                    p = model.probabilities(np.concatenate(x)).astype(np.float64)
                    mean = np.add.reduceat(p, np.cumsum(n) - n, axis=0) / n[:, None]
                    best = mean.argmax(axis=1)
                    for j, i in enumerate(rows):
                        lang[i] = model.classes[best[j]]
                        score[i] = min(1.0, float(mean[j, best[j]]))
                yield pa.RecordBatch.from_arrays(
                    [*b.columns[1:], pa.array(lang), pa.array(score, pa.float64())], names=names)
        release()

    ship(docs.sparkSession)
    whole = free_name(docs, "__text")
    text = F.col("text").cast("string").alias(whole)
    rows = docs.select(text, *(docs.columns if carry else [F.col("doc_id").cast("long").alias("doc_id")]))
    names = rows.columns[1:] + (carried_names(docs) if carry else ["lang_pred", "score"])
    kinds = [f.dataType.simpleString() for f in rows.schema.fields[1:]] + ["string", "double"]
    return rows.mapInArrow(work, ", ".join(f"`{n}` {k}" for n, k in zip(names, kinds)))


def identify(docs: DataFrame) -> DataFrame:
    """Train on the rows that are not held out and predict every row."""
    model = train(docs, ~held_out())
    return predict(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
