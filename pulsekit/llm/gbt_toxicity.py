"""Operator 5: toxicity by gradient-boosted trees over dense text features.

Features: how densely a text holds words, and beginnings of words, of a learned
lexicon (also after common letter substitutes are undone), the largest weight of
such a word, how many of them stand near a second-person word, capitals,
punctuation marks, and words that mix letters with digits or symbols.

The lexicon is learned from labelled texts: words (and first letters of words)
that stand in toxic texts after many different words, and far less so in others.
Counting the words before, not the texts, keeps a text with thousands of copies
from putting all its words into the lexicon.  Trees (numpy, on the driver) are
fitted by second-order boosting over binned features; the scores are calibrated
by isotonic regression on texts that the lexicon and the trees did not see, and
interpolated between its steps.

At most ``sample_per_label`` labelled texts of each label are used, chosen by a
hash of their ids; prediction reads nothing but the text.  Null texts are empty
and get the score of a text without any sign; so does every text when no row of
some label is known.  A document labelled twice counts as toxic if one label
says so; labels without text, or null ones, teach nothing.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsekit.llm.common import id_and_text, pieces

#: Second-person words of the supported languages (fixed values).
SECOND_PERSON = frozenset(
    "you your yours yourself youre u ur du dich dir dein deine deinen deiner ihr euch euer "
    "tu te toi ton ta tes vous votre vos tú ti tuyo tuya usted ustedes vosotros vuestro".split())
#: Digits and symbols that stand for letters (fixed values).
SUBSTITUTES = str.maketrans("013457@$!", "oieastasi")
LETTERS = re.compile(r"[^\W\d_]+")
MIXED = re.compile(r"[^\W\d_][\d@$*#%.\-_]{1,3}(?=[^\W\d_])|(.)\1{3,}", re.S)
CAPS = re.compile(r"\b[^\W\d_a-zß-öø-ÿ]{3,}\b")

FEATURES = ("words", "beginnings", "substituted", "strongest", "hits", "near_second_person", "second_person",
            "capitals", "capital_words", "exclamations", "questions", "punctuation", "mixed", "log_words")


@dataclass
class Lexicon:
    words: dict[str, float]           # log odds
    beginnings: dict[str, float]      # of the first 4 or 5 letters

    def features(self, text: str) -> list[float]:
        low = text.lower()
        found = LETTERS.findall(low)
        n = len(found) or 1
        words, begins = self.words, self.beginnings
        hits = [i for i, w in enumerate(found) if w in words]
        marked = [i for i, w in enumerate(found) if w[:5] in begins or w[:4] in begins]
        persons = [i for i, w in enumerate(found) if w in SECOND_PERSON]
        at = set(persons)
        signs = {*hits, *marked}
        near = sum(any(i + d in at for d in (-3, -2, -1, 1, 2, 3)) for i in signs)
        mixed = sum(1 for _ in MIXED.finditer(text))
        masked = 0
        if mixed:
            plain = [re.sub(r"[^\w]|_", "", t.translate(SUBSTITUTES)) for t in low.split() if not t.isalpha()]
            masked = sum(w in words or w[:5] in begins for w in plain) - sum(
                1 for t in low.split() if not t.isalpha() and t.strip(".,!?;:\"'()") in words)
        strongest = max([words[found[i]] for i in hits] + [begins.get(found[i][:5], begins.get(found[i][:4], 0.0))
                                                            for i in marked], default=0.0)
        letters = sum(map(len, found)) or 1
        caps = CAPS.findall(text)
        capitals = sum(map(len, caps))
        bang, ask = text.count("!"), text.count("?")
        marks = bang + ask + text.count(".") + text.count(",") + text.count(";") + text.count(":")
        return [len(hits) / n, len(marked) / n, max(0, masked) / n, strongest, min(len(signs), 50), near / n,
                len(persons) / n, capitals / letters, len(caps) / n, bang / n, ask / n, marks / n, mixed / n,
                float(np.log1p(len(found)))]


class Trees:
    """Boosted regression trees on the logistic loss, over quantile bins."""

    def __init__(self, x: np.ndarray, y: np.ndarray, rounds: int = 60, depth: int = 3, rate: float = 0.2,
                 bins: int = 64, ridge: float = 1.0, least: float = 4.0):
        inner = np.linspace(0, 1, bins + 1)[1:-1]
        self.cuts = [np.unique(np.quantile(x[:, j], inner)) for j in range(x.shape[1])]
        code = self.binned(x)
        p = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.start = float(np.log(p / (1 - p)))
        self.trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        f = np.full(len(y), self.start)
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-f))
            tree = self._grow(code, p - y, np.maximum(p * (1 - p), 1e-6), depth, ridge, least, rate)
            self.trees.append(tree)
            f += self._apply(code, tree)

    def binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, x[:, j], side="right") for j, c in enumerate(self.cuts)], axis=1)

    def _grow(self, code, grad, hess, depth, ridge, least, rate):
        """A full tree as arrays by node: feature, bin (go right above), value."""
        size = 2 ** (depth + 1) - 1
        feature, cut, value = np.full(size, -1), np.zeros(size, int), np.zeros(size)
        rows = {0: np.arange(len(grad))}
        for node in range(size):
            r = rows.pop(node, None)
            if r is None:
                continue
            g, h = grad[r].sum(), hess[r].sum()
            value[node] = -rate * g / (h + ridge)
            if node >= size // 2:
                continue
            best = (1e-6, None)
            for j, c in enumerate(self.cuts):
                if not len(c):
                    continue
                gl = np.cumsum(np.bincount(code[r, j], grad[r], len(c) + 1))[:-1]
                hl = np.cumsum(np.bincount(code[r, j], hess[r], len(c) + 1))[:-1]
                gain = gl ** 2 / (hl + ridge) + (g - gl) ** 2 / (h - hl + ridge) - g ** 2 / (h + ridge)
                gain[(hl < least) | (h - hl < least)] = 0
                k = int(gain.argmax())
                if gain[k] > best[0]:
                    best = (gain[k], (j, k))
            if best[1]:
                j, k = best[1]
                feature[node], cut[node] = j, k
                right = code[r, j] > k
                rows[2 * node + 1], rows[2 * node + 2] = r[~right], r[right]
        return feature, cut, value

    @staticmethod
    def _apply(code, tree):
        feature, cut, value = tree
        node = np.zeros(len(code), int)
        for _ in range(int(np.log2(len(feature) + 1)) - 1):
            f = feature[node]
            go = np.where(f >= 0, 2 * node + 1 + (code[np.arange(len(code)), np.maximum(f, 0)] > cut[node]), node)
            node = go
        return value[node]

    def margin(self, x: np.ndarray) -> np.ndarray:
        code = self.binned(x)
        return self.start + sum((self._apply(code, t) for t in self.trees), np.zeros(len(x)))


def isotonic(score: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: (mean score, mean label) of each block.  One
    pseudo-count of each label keeps the ends off 0 and 1."""
    order = np.argsort(score, kind="stable")
    s = np.concatenate([[score.min() - 1], score[order], [score.max() + 1]])
    t = np.concatenate([[0.5], y[order], [0.5]]).astype(float)
    blocks: list[list[float]] = []                       # weight, sum of scores, sum of labels
    for a, b in zip(s, t):
        blocks.append([1.0, a, b])
        while len(blocks) > 1 and blocks[-2][2] / blocks[-2][0] >= blocks[-1][2] / blocks[-1][0]:
            w, a2, b2 = blocks.pop()
            blocks[-1] = [blocks[-1][0] + w, blocks[-1][1] + a2, blocks[-1][2] + b2]
    w = np.array(blocks)
    return w[:, 1] / w[:, 0], w[:, 2] / w[:, 0]


@dataclass
class Model:
    lexicon: Lexicon
    trees: Trees
    knots: tuple[np.ndarray, np.ndarray]

    def score(self, texts: list[str]) -> np.ndarray:
        x = np.array([self.lexicon.features(t) for t in texts]).reshape(-1, len(FEATURES))
        m = self.trees.margin(x)
        # a hundredth of the score keeps the margins' order within a step
        return 0.99 * np.interp(m, *self.knots) + 0.01 / (1 + np.exp(-m))


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def learn_lexicon(sample: DataFrame, least: int = 4, odds: float = 6.0, size: int = 5000) -> Lexicon:
    """From rows (text, toxic): at most ``size`` words and as many beginnings."""

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            seen: dict[tuple[str, str], list[int]] = {}
            for text, toxic in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                found = LETTERS.findall(text.lower())
                for pair in set(zip(found, ["", *found])):
                    seen.setdefault(pair, [0, 0])[toxic] = 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([w for w, _ in seen], pa.string()), pa.array([p for _, p in seen], pa.string()),
                 pa.array([n[0] for n in seen.values()], pa.int32()), pa.array([n[1] for n in seen.values()], pa.int32())],
                names=["word", "before", "clean", "toxic"])

    pairs = sample.select("text", "toxic").mapInArrow(words, "word string, before string, clean int, toxic int")
    by_word = (pairs.groupBy("word", "before").agg(F.max("clean").alias("clean"), F.max("toxic").alias("toxic"))
               .groupBy("word").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")))
    keys = by_word.select(F.explode(F.array(
        F.struct(F.lit(0).alias("letters"), F.col("word").alias("key")),
        F.struct(F.lit(4).alias("letters"), F.substring("word", 1, 4).alias("key")),
        F.struct(F.lit(5).alias("letters"), F.substring("word", 1, 5).alias("key")))).alias("k"), "clean", "toxic")
    keys = (keys.where((F.col("k.letters") == 0) | (F.length("k.key") == F.col("k.letters")))
            .groupBy("k.letters", "k.key").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
            .withColumn("weight", F.log((F.col("toxic") + 0.5) / (F.col("clean") + 0.5)))
            .where((F.col("toxic") >= F.when(F.col("letters") == 0, least).otherwise(2 * least - 2))
                   & (F.col("weight") >= float(np.log(odds)))))
    found = keys.orderBy(F.desc("weight"), F.desc("toxic"), "letters", "key").limit(2 * size).collect()
    return Lexicon({r["key"]: r["weight"] for r in found if r["letters"] == 0},
                   {r["key"]: r["weight"] for r in found if r["letters"]})


def train(docs: DataFrame, labels: DataFrame, sample_per_label: int = 4000, seed: int = 5) -> Model | None:
    rows = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
            .where("doc_id is not null and toxic in (0, 1)").where(~held_out())
            .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    key = F.xxhash64("doc_id", F.lit(seed))
    chosen = None
    for label in (0, 1):
        part = rows.where(F.col("toxic") == label).orderBy(key, "doc_id").limit(sample_per_label)
        chosen = part if chosen is None else chosen.unionByName(part)
    # at most 2 x sample_per_label ids: small enough to go to every task
    sample = (id_and_text(docs).join(F.broadcast(chosen), "doc_id")
              .dropDuplicates(["doc_id"]).withColumn("calibrate", F.pmod(F.xxhash64("text"), F.lit(4)) == 0)
              .checkpoint())
    fit = sample.where(~F.col("calibrate")).dropDuplicates(["text"])
    lexicon = learn_lexicon(fit)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = [lexicon.features(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(x, pa.list_(pa.float64())), b.column(2), b.column(3)],
                                             names=["doc_id", "x", "toxic", "calibrate"])

    got = (sample.select("doc_id", "text", "toxic", "calibrate")
           .mapInArrow(features, "doc_id long, x array<double>, toxic int, calibrate boolean")
           .toPandas().sort_values("doc_id"))
    part = got["calibrate"].to_numpy(bool)
    x = np.array(got["x"].tolist()).reshape(-1, len(FEATURES))
    y = got["toxic"].to_numpy(float)
    if len(set(y[~part])) < 2 or not part.any():
        return None
    trees = Trees(x[~part], y[~part])
    return Model(lexicon, trees, isotonic(trees.margin(x[part]), y[part]))


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, score and predicted of every row."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in pieces(batch):
                s = model.score(b.column(1).to_pylist()) if model else np.zeros(b.num_rows)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array(s), pa.array((s >= 0.5).astype(np.int32))], names=["doc_id", "score", "predicted"])

    return id_and_text(docs).mapInArrow(work, "doc_id long, score double, predicted int")


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Train on the labelled rows that are not held out and score every row."""
    from pulsekit.session import shared_dir

    shared_dir(docs.sparkSession)
    return (score(docs, train(docs, labels))
            .select("doc_id", held_out().alias("held_out"), "score", "predicted"))
