"""Toxicity by a classifier chain.

Categories are learned one after another by linear (logistic) models on the
words of a text; each later model also reads the log-odds that the earlier ones
give, and those are out-of-fold predictions in training, so that a later model
learns how far the earlier ones can be trusted. The last link is the overall
label. Which texts belong to the categories before it is given by marker words
among the texts labelled toxic (fixed values below), since the label table has
one column; the links then generalise over the whole vocabulary.

Training reads at most SAMPLE labelled texts of each class of the training
folds, chosen by a hash of doc_id. Their vocabulary is counted by Spark: words in
MIN_DOCS of them or more whose share of toxic texts is LEAST_Z standard errors
or more off the mean, the VOCABULARY farthest. Only lists of word numbers reach
the driver. Scoring is one pass over whole texts without a
shuffle; words are matched exactly, not hashed, so rare words of clean texts
cannot collide with toxic ones.

Null and empty texts have no words and are scored by the intercepts. A null
doc_id is scored and never trained on; repeated rows are scored alike. Without
labelled texts of both classes every score is 0. Other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import stage
from quire.llm.labelled import held_out, labels_of, sample

#: Marker words of the categories (fixed values).
CATEGORIES = {
    "insult": ["idiot", "moron", "stupid", "loser", "clown"],
    "contempt": ["worthless", "trash", "scum", "garbage", "vermin"],
    "disgust": ["disgusting", "pathetic", "filthy", "vile"],
}
SAMPLE = 8_000
VOCABULARY = 2_000
MIN_DOCS = 5
LEAST_Z = 4.0
FOLDS = 4
STEPS = 150
THRESHOLD = 0.5
_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    """Distinct lower-case words (runs of letters) of a whole text."""
    return list(set(_WORD.findall((text or "").lower())))


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


class Rows:
    """Sparse 0/1 rows: word numbers of all rows, row by row."""

    def __init__(self, lists: list[np.ndarray]):
        self.n = len(lists)
        self.row = np.repeat(np.arange(self.n), [len(x) for x in lists])
        self.col = np.concatenate([*lists, np.zeros(0, np.int64)]).astype(np.int64)

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, w[self.col], self.n)

    def gather(self, r: np.ndarray, size: int) -> np.ndarray:
        return np.bincount(self.col, r[self.row], size)

    def part(self, chosen: np.ndarray) -> Rows:
        out = Rows.__new__(Rows)
        keep = chosen[self.row]
        out.n = int(chosen.sum())
        out.row, out.col = (np.cumsum(chosen) - 1)[self.row[keep]], self.col[keep]
        return out


@dataclass
class Link:
    words: np.ndarray
    chain: np.ndarray
    bias: float

    def odds(self, rows: Rows, before: np.ndarray) -> np.ndarray:
        return rows.dot(self.words) + before @ self.chain + self.bias


def fit_link(rows: Rows, before: np.ndarray, y: np.ndarray, size: int, steps: int = STEPS, l2: float = 1e-3) -> Link:
    """Logistic regression with balanced classes by Adam."""
    weight = np.where(y > 0, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1))
    k = before.shape[1]
    w, m, v = np.zeros(size + k + 1), np.zeros(size + k + 1), np.zeros(size + k + 1)
    for t in range(1, steps + 1):
        p = _sigmoid(rows.dot(w[:size]) + before @ w[size:size + k] + w[-1])
        r = (p - y) * weight
        g = np.concatenate([rows.gather(r, size), r @ before, [r.sum()]])
        g[:-1] += l2 * w[:-1]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return Link(w[:size], w[size:size + k], float(w[-1]))


@dataclass
class Chain:
    vocabulary: dict[str, int]
    names: list[str]
    links: list[Link] = field(default_factory=list)

    def probabilities(self, lists: list[np.ndarray]) -> np.ndarray:
        rows, odds = Rows(lists), np.zeros((len(lists), 0))
        for link in self.links:
            odds = np.hstack([odds, np.clip(link.odds(rows, odds), -8, 8)[:, None]])
        return _sigmoid(odds)

    def numbers(self, text: str | None) -> np.ndarray:
        found = [self.vocabulary[w] for w in words_of(text) if w in self.vocabulary]
        return np.array(sorted(found), np.int64)


def fit_chain(lists: list[np.ndarray], labels: dict[str, np.ndarray], vocabulary: dict[str, int], folds: int = FOLDS) -> Chain:
    """One link per label, in order, with out-of-fold odds as later links' inputs."""
    rows, size = Rows(lists), len(vocabulary)
    fold = np.arange(rows.n) % folds
    chain, odds = Chain(vocabulary, list(labels)), np.zeros((rows.n, 0))
    for y in labels.values():
        out = np.zeros(rows.n)
        for f in range(folds):
            rest = fold != f
            link = fit_link(rows.part(rest), odds[rest], y[rest], size)
            out[~rest] = link.odds(rows.part(~rest), odds[~rest])
        chain.links.append(fit_link(rows, odds, y, size))
        odds = np.hstack([odds, np.clip(out, -8, 8)[:, None]])
    return chain


def _word_rows(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in parts:
        found = [words_of(t) for t in part.column(0).to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.string())), part.column(1), part.column(2)],
                                         names=["words", "doc_id", "label"])


def train(docs: DataFrame, labels: DataFrame, size: int = SAMPLE, column: str = "toxic",
          categories: dict[str, list[str]] | None = None) -> Chain | None:
    categories = CATEGORIES if categories is None else categories
    known = labels_of(labels, column)
    chosen = sample(known.where("label = 1"), size).unionByName(sample(known.where("label = 0"), size))
    texts = docs.select(F.col("text").cast("string").alias("text"), F.col("doc_id").cast("long").alias("doc_id"))
    rows = texts.join(F.broadcast(chosen), "doc_id").select("text", "doc_id", "label") \
        .mapInArrow(_word_rows, "words array<string>, doc_id long, label int")
    picked = sample(rows.where("label = 1"), size).unionByName(sample(rows.where("label = 0"), size))
    picked = stage(picked, "toxic-sample")
    share = picked.agg(F.avg("label")).first()[0] or 0.0
    n = F.col("n")
    counts = picked.select(F.explode("words").alias("word"), "label").groupBy("word") \
        .agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("bad")).where(n >= MIN_DOCS) \
        .withColumn("z", F.abs(F.col("bad") - n * share) / F.sqrt(n * max(share * (1 - share), 1e-9))) \
        .where(F.col("z") >= LEAST_Z).orderBy(F.desc("z"), "word").limit(VOCABULARY).collect()
    vocabulary = {r["word"]: i for i, r in enumerate(counts)}
    table = docs.sparkSession.createDataFrame([(w, i) for w, i in vocabulary.items()] or [("", -1)], "word string, k int")
    keyed = picked.withColumn("row", F.monotonically_increasing_id())
    lists = keyed.select("row", F.explode("words").alias("word")).join(F.broadcast(table), "word") \
        .groupBy("row").agg(F.sort_array(F.collect_list("k")).alias("ks"))
    found = keyed.select("row", "doc_id", "label").join(lists, "row", "left").orderBy("doc_id", "row").collect()
    y = np.array([r["label"] for r in found], float)
    if not len(y) or y.min() == y.max():
        return None
    word_lists = [np.array(r["ks"] or [], np.int64) for r in found]
    every = {}
    for name, markers in categories.items():
        ks = [vocabulary[w] for w in markers if w in vocabulary]
        member = np.array([np.isin(x, ks).any() for x in word_lists], float) * y
        if 0 < member.sum() < len(y):
            every[name] = member
    return fit_chain(word_lists, every | {column: y}, vocabulary)


def classify(docs: DataFrame, labels: DataFrame, size: int = SAMPLE, threshold: float = THRESHOLD,
             column: str = "toxic") -> DataFrame:
    """Per row of `docs`: doc_id, held_out, categories (name -> probability), score and predicted."""
    chain = train(docs, labels, size, column)
    keyed = docs.select(F.col("text").cast("string").alias("text"), F.col("doc_id").cast("long").alias("doc_id")) \
        .withColumn("held_out", held_out(F.col("doc_id")))

    def judge(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            texts = part.column(0).to_pylist()
            names = chain.names if chain else [column]
            p = chain.probabilities([chain.numbers(t) for t in texts]) if chain else np.zeros((len(texts), 1))
            maps = pa.array([list(zip(names, x)) for x in p.tolist()], pa.map_(pa.string(), pa.float64()))
            yield pa.RecordBatch.from_arrays(
                [part.column(1), part.column(2), maps, pa.array(p[:, -1]), pa.array((p[:, -1] >= threshold).astype(np.int32))],
                names=["doc_id", "held_out", "categories", "score", "predicted"])

    return keyed.mapInArrow(judge, "doc_id long, held_out boolean, categories map<string,double>, score double, predicted int")
