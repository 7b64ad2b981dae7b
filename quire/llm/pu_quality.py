"""Quality classifier by positive-unlabelled learning.

Trusted positives (label 1) and unlabelled texts train a linear model on text
statistics by minimising the non-negative unbiased risk

    prior * E_P[l(f)] + max(0, E_U[l(-f)] - prior * E_P[l(-f)])

with the logistic loss, so its sigmoid is the probability of a good text. Rows
labelled 0 are never used. With this loss the unbiased risk is convex; it is minimised
by Newton's method under a Gaussian prior of the weights, which ends where it would take
the second term below zero. The class prior is estimated from the same rows: a model that tells positives from
unlabelled texts ranks both; over all cuts that keep enough held-back positives, the
least ratio of kept unlabelled to kept positive texts bounds the share of positives
among the unlabelled.

Training reads at most SAMPLE labelled positives, chosen by a hash of doc_id, and
all unlabelled texts of the training folds. Their statistics are staged once (a
few dozen numbers a text); the inputs' mean and scale, the prior's counts and the
gradient and Hessian of each step tried (some dozens in all) are sums over all of
them by Spark. Only the positives' numbers (a few MB) and those sums reach the
driver. Scoring is one pass without a shuffle.

Null and empty texts have statistics like any other and get a score. A null
doc_id is scored and never trained on; repeated rows are scored alike and each count
as a text; very long texts are read whole, one at a time. Ties of the positives'
hash go by doc_id, between rows of one doc_id to any (an empty table has no rows). Without
positives every score is the neutral 0.5. Other columns are not read: neither
labels nor lang, source or doc_id are inputs of a score.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import frugal, stage, texts
from quire.llm.labelled import held_out, labels_of, sample

SAMPLE = 20_000
THRESHOLD = 0.3
MAX_STEPS = 25
MAX_HALVINGS = 12
TOLERANCE = 1e-7
RIDGE = 3.0  # a Gaussian prior of each weight of variance 1 / RIDGE; chosen by the labels of the training folds
_CLASSES = {"symbol": b"#*$%&|<>", "digit": b"0123456789", "upper": bytes(range(65, 91)), "lower": bytes(range(97, 123)),
            "stop": b".,;:", "mark": b"!?", "quote": b"\"'()[]{}", "other": b"+=-_/\\@^~`"}
FEATURES = ["log_words", "word_bytes", *_CLASSES, "caps_words", "mark_words", "bar_words", "adjacent", "distinct",
            "repeated3", "repeated_lines", "line_words", "stop_ended"]


def _class_table() -> np.ndarray:
    table = np.zeros((256, len(_CLASSES)))
    for k, chars in enumerate(_CLASSES.values()):
        table[list(chars), k] = 1
    return table


_CLASS_OF = _class_table()


def statistics(text: str | None) -> list[float]:
    """The FEATURES of a whole text; all are finite, shares lie in 0 .. 1."""
    data = (text or "").encode()
    words = data.split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    size = sum(map(len, words))
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256) @ _CLASS_OF
    windows = n - 2
    lines = [x for x in data.split(b"\n") if x.strip()]
    ends = [w[-1] for w in words]
    return [np.log1p(n), size / n, *(np.sqrt(counts / size)),
            np.sqrt(sum(map(bytes.isupper, words)) / n), np.sqrt(sum(e == 33 for e in ends) / n),
            np.sqrt(words.count(b"|") / n), np.sqrt(sum(map(eq, words, words[1:])) / n),
            len(set(words)) / n * min(1.0, np.sqrt(n / 100)),
            np.sqrt(1 - len(set(zip(words, words[1:], words[2:]))) / windows) if windows > 0 else 0.0,
            np.sqrt(1 - len(set(lines)) / len(lines)), np.log1p(n / len(lines)),
            np.sqrt(sum(e in b".,;:" for e in ends) / n)]


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    prior: float

    def inputs(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -4, 4)
        return np.hstack([z, z * z, np.ones((len(z), 1))])

    def score(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.inputs(x) @ self.weights)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def _total_of(unlabelled: DataFrame | np.ndarray) -> Callable:
    """total(make): the sum of `make(x)` over blocks x of the unlabelled rows of FEATURES. Of a
    DataFrame (x) each task adds up its own blocks, Spark adds the tasks' sums place by place."""
    if isinstance(unlabelled, np.ndarray):
        return lambda make: make(unlabelled)

    def total(make) -> np.ndarray:
        def add(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = None
            for part in parts:
                if part.num_rows:
                    mine = make(part.column(0).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, len(FEATURES)))
                    held = mine if held is None else held + mine
            if held is not None:
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(held))), pa.array(held)], names=["place", "value"])

        found = unlabelled.select("x").mapInArrow(add, "place long, value double").groupBy("place").agg(F.sum("value")).collect()
        out = np.zeros(len(found))
        for place, value in found:
            out[place] = value
        return out

    return total


def _logistic(z: np.ndarray, w: np.ndarray, sign: float) -> np.ndarray:
    """Sums over rows z of l(sign * f): rows, value, gradient and flattened Hessian at w."""
    f = sign * (z @ w)
    miss = _sigmoid(-f)
    return np.concatenate([[len(z), np.logaddexp(0, -f).sum()], -sign * (z * miss[:, None]).sum(axis=0),
                           ((z * (miss * (1 - miss))[:, None]).T @ z).ravel()])


def _mean(sums: np.ndarray, size: int) -> tuple[float, np.ndarray, np.ndarray]:
    mean = sums[1:] / sums[0]
    return mean[0], mean[1:size + 1], mean[size + 1:].reshape(size, size)


def _minimise(risk, size: int, ridge: float, steps: int = MAX_STEPS) -> np.ndarray:
    """Newton's method from zero with step halving; `risk(w)` gives value (None where the
    non-negative term would fall below zero), gradient and Hessian of a convex risk."""
    w = np.zeros(size)
    value, slope, bend = risk(w)
    for _ in range(steps):
        slope, bend = slope + ridge * w, bend + ridge * np.eye(size)
        step, now = -np.linalg.solve(bend, slope), value + ridge / 2 * w @ w
        if -slope @ step < TOLERANCE:
            break
        for _ in range(MAX_HALVINGS):
            found, *rest = risk(w + step)
            if found is not None and found + ridge / 2 * (w + step) @ (w + step) <= now:
                break
            step = step / 2
        else:
            break
        w, value, (slope, bend) = w + step, found, rest
    return w


def estimate_prior(model: Model, positive: np.ndarray, total: Callable) -> float:
    """Share of positives (model inputs) among all unlabelled rows."""
    train, back = positive[::2], positive[1::2]
    if not len(back):
        return 0.5
    size = train.shape[1]

    def risk(w):
        p = _mean(_logistic(train, w, 1.0), size)
        u = _mean(total(lambda x: _logistic(model.inputs(x), w, -1.0)), size)
        return tuple(a + b for a, b in zip(p, u))

    w = _minimise(risk, size, 1e-3)
    kept = np.sort(back @ w)
    cuts = kept[: max(1, int(0.9 * len(kept)))]  # keep a tenth of the positives at least
    reached = total(lambda x: np.bincount(np.searchsorted(cuts, model.inputs(x) @ w, "right"), minlength=len(cuts) + 1).astype(float))
    n = reached.sum()
    q_p = 1 - np.arange(len(cuts)) / len(kept)
    q_u = reached[::-1].cumsum()[::-1][1:] / n
    slack = np.sqrt(np.log(4 / 0.1) / 2) * (1 / np.sqrt(len(kept)) + 1 / np.sqrt(n))
    best = int(np.argmin((q_u + slack) / q_p))
    return float(np.clip(q_u[best] / q_p[best], 0.01, 0.99))


def fit(positive: np.ndarray, unlabelled: DataFrame | np.ndarray, prior: float | None = None) -> Model | None:
    """Model of least non-negative risk from rows of FEATURES: an array of positives,
    and an array or a DataFrame (x) of unlabelled ones, of which every row counts."""
    total = _total_of(unlabelled)
    sums = total(lambda x: np.concatenate([[len(x)], x.sum(axis=0)]))
    if not len(sums) or not len(positive):
        return None
    n, mean = sums[0], sums[1:] / sums[0]
    scale = np.sqrt(total(lambda x: ((x - mean) ** 2).sum(axis=0)) / n)
    size = 2 * len(mean) + 1
    model = Model(mean, scale + 1e-3, np.zeros(size), 0.5)
    p = model.inputs(positive)
    model.prior = prior if prior is not None else estimate_prior(model, p, total)
    toward = p.mean(axis=0)

    def risk(w):  # l(f) - l(-f) = -f: the unbiased risk is convex, and it is the non-negative one while `spare` is not negative
        value, slope, bend = _mean(total(lambda x: _logistic(model.inputs(x), w, -1.0)), size)
        spare = value - model.prior * np.logaddexp(0, p @ w).mean()
        return (value - model.prior * toward @ w if spare >= 0 else None), slope - model.prior * toward, bend

    model.weights = _minimise(risk, size, RIDGE / len(p))
    return model


def _table(column: pa.Array) -> np.ndarray:
    """A row of FEATURES for each text of an Arrow column."""
    out = np.empty((len(column), len(FEATURES)))
    for i, text in enumerate(texts(column)):
        out[i] = statistics(text)
    return out


def _statistics_rows(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in parts:
        x = _table(part.column(0)).astype(np.float32)
        places = pa.array(np.arange(len(x) + 1, dtype=np.int32) * np.int32(len(FEATURES)))
        yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(places, pa.array(x.ravel())), part.column(1), part.column(2)],
                                         names=["x", "positive", "doc_id"])


def train(docs: DataFrame, labels: DataFrame, size: int = SAMPLE, column: str = "quality") -> Model | None:
    """Fit on at most `size` positives and all unlabelled rows of the training folds of `docs` (doc_id, text)."""
    positives = sample(labels_of(labels, column).where("label = 1").select("doc_id"), size)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .where("doc_id IS NOT NULL").where(~held_out(F.col("doc_id")))
    chosen = F.broadcast(positives.withColumn("positive", F.lit(True)))  # `size` ids at most
    read = rows.join(chosen, "doc_id", "left").select("text", F.coalesce("positive", F.lit(False)).alias("positive"), "doc_id")
    rows = stage(read.mapInArrow(frugal(_statistics_rows), "x array<float>, positive boolean, doc_id long"), "statistics")
    found = sample(rows.where("positive"), size).select("x").collect()
    return fit(np.array([r["x"] for r in found]).reshape(-1, len(FEATURES)), rows.select("x"))


def score(docs: DataFrame, model: Model | None, keep: list[str], threshold: float = THRESHOLD) -> DataFrame:
    """`keep` columns of `docs`, score and predicted, for every row."""
    schema = docs.select(*keep).schema.add("score", "double").add("predicted", "integer")

    def judge(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            x = _table(part.column(0))
            s = model.score(x) if model is not None else np.full(len(x), 0.5)
            yield pa.RecordBatch.from_arrays([*part.columns[1:], pa.array(s), pa.array((s >= threshold).astype(np.int32))],
                                             names=[*part.schema.names[1:], "score", "predicted"])

    return docs.select(F.col("text").cast("string").alias("__text"), *keep).mapInArrow(frugal(judge), schema)


def classify(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> DataFrame:
    """Per row of `docs`: doc_id, held_out, score, predicted."""
    keyed = docs.select("text", F.col("doc_id").cast("long").alias("doc_id")).withColumn("held_out", held_out(F.col("doc_id")))
    return score(keyed, train(docs, labels, size), ["doc_id", "held_out"])
