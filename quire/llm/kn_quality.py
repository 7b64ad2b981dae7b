"""Quality rules with an n-gram language model.

Base rules look at words, symbols, repeated lines and repeated three-word
windows. Texts that pass are judged by the perplexity of a modified Kneser-Ney
model over UTF-8 bytes (ORDER bytes), one per language: documents outside the
language's lower and upper perplexity bands are rejected.

The model is counted by Spark over all documents: tasks emit the counts of their
own text's distinct n-grams, which are summed by key; continuation counts,
discounts (from counts of counts) and interpolated probabilities of each order
are aggregations and joins over those tables. It is written to the shared folder
and read by scoring tasks as sorted arrays of n-gram hashes (a bijection of the
n-gram, so without collisions) with binary search. If the arrays take more than
MODEL_BYTES, documents are scored by a join of their n-gram counts with the
model's table instead; both ways give the same perplexities.

The bands are the quartiles of the log-perplexities of the language's documents,
SPREAD interquartile ranges (MARGIN bits at least) further out on either side.

A null or empty text has no words and fails. Unknown (null) languages share one
model. Rows that repeat a doc_id are judged each on its own; a null doc_id is
kept. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.common import open_fs, shared_folder, stage, with_uid

ORDER = 4
MODEL_BYTES = 1 << 27
MAX_BROADCAST_ROWS = 10_000
SPREAD = 4.0
MARGIN = 0.15
MIN_WORDS = 50
SYMBOLS = b"#*$%&|<>"
_SPACES = " \t\n\x0b\x0c\r"


def dup_lines(data: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in data.split(b"\n") if x.strip()] if b"\n" in data else []
    return len(lines) - len(set(lines))


def repeat_words(words: list[bytes]) -> int:
    """Words in three-word windows found twice or more."""
    repeated = 0
    if len(set(zip(words, words[1:], words[2:]))) < len(words) - 2:
        windows = list(zip(words, words[1:], words[2:]))
        count = Counter(windows)
        reach = 0  # words before this index are counted
        for i, w in enumerate(windows):
            if count[w] > 1:
                repeated += i + 3 - max(i, reach)
                reach = i + 3
    return repeated


def base_counts(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a whole text."""
    data = (text or "").encode()
    words = data.split()
    if not words:
        return 0, 0, 0, 0, 0
    chars = sum((b & 0xC0) != 0x80 for b in b"".join(words)) if not data.isascii() else sum(map(len, words))
    symbols = len(data) - len(data.translate(None, SYMBOLS))
    return len(words), chars, symbols, dup_lines(data), repeat_words(words)


def _grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """n-grams ending at each byte of each text (zero bytes before it), as unsigned
    32-bit numbers, and the number of them per text."""
    pad = b"\0" * (ORDER - 1)
    flat = np.frombuffer(b"".join(pad + t.replace(b"\0", b"\1") for t in texts), np.uint8).astype(np.uint32)
    if len(flat) < ORDER:
        return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
    keys = flat[ORDER - 1:].copy()
    for k in range(1, ORDER):
        keys |= flat[ORDER - 1 - k:len(flat) - k] << np.uint32(8 * k)
    return keys[flat[ORDER - 1:] != 0], np.array([len(t) for t in texts], np.int64)


def _by_language(langs: list[str], texts: list[str | None]) -> Iterator[tuple[str, list[int]]]:
    groups: dict[str, list[int]] = {}
    for i, lang in enumerate(langs):
        groups.setdefault(lang, []).append(i)
    yield from groups.items()


def count_grams(rows: DataFrame) -> DataFrame:
    """(lang, gram, n) over all `rows` (lang, text)."""
    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}

        def merge(found):
            keys = np.concatenate([k for k, _ in found])
            uniq, at = np.unique(keys, return_inverse=True)
            return uniq, np.bincount(at, np.concatenate([n for _, n in found])).astype(np.int64)

        for part in parts:
            langs, texts = part.column(0).to_pylist(), part.column(1).to_pylist()
            for lang, idx in _by_language(langs, texts):
                mine = held.setdefault(lang, [])
                keys, _ = _grams([(texts[i] or "").encode() for i in idx])
                mine.append(np.unique(keys, return_counts=True))
                if len(mine) > 16:
                    held[lang] = [merge(mine)]
        for lang, found in held.items():
            keys, n = merge(found)
            for i in range(0, len(keys), 100_000):
                k = keys[i:i + 100_000]
                yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(k)), "gram": pa.array(k.astype(np.int64)),
                                                  "n": pa.array(n[i:i + 100_000])})

    return rows.select("lang", "text").mapInArrow(count, "lang string, gram long, n long") \
        .groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _per_language(table: DataFrame) -> DataFrame:
    """A table of one row per language, for joins: broadcast if it is measured small."""
    held = stage(table, "languages")
    return F.broadcast(held) if held.count() <= MAX_BROADCAST_ROWS else held


def _discounted(counts: DataFrame) -> DataFrame:
    """counts (lang, gram, n) -> lang, gram, own (discounted share of its context) and
    back (weight of the context's lower order)."""
    tally = counts.groupBy("lang").agg(*[F.count_if(F.col("n") == k).alias(f"n{k}") for k in (1, 2, 3, 4)])
    y = F.try_divide(F.col("n1"), F.col("n1") + 2 * F.col("n2"))

    def discount(k: int) -> Column:  # modified Kneser-Ney, 1/2 where counts of counts are missing
        d = F.lit(float(k)) - (k + 1) * y * F.try_divide(F.col(f"n{k + 1}"), F.col(f"n{k}"))
        return F.when((F.col("n1") > 0) & (F.col("n2") > 0) & (F.col(f"n{k}") > 0) & (d > 0) & (d < k), d).otherwise(0.5)

    d = tally.select("lang", *[discount(k).alias(f"d{k}") for k in (1, 2, 3)])
    rows = counts.join(_per_language(d), "lang").withColumn(
        "cut", F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))) \
        .withColumn("ctx", F.shiftright("gram", 8))
    context = rows.groupBy("lang", "ctx").agg(F.sum("n").alias("total"), F.sum("cut").alias("freed"))
    return rows.join(context, ["lang", "ctx"]).select(
        "lang", "gram", ((F.col("n") - F.col("cut")) / F.col("total")).alias("own"), (F.col("freed") / F.col("total")).alias("back"))


def model_table(counts: DataFrame) -> DataFrame:
    """(lang, gram, bits): -log2 of the interpolated probability of each n-gram's
    last byte after the others, from the n-gram counts."""
    tables = [counts]
    for k in range(ORDER - 1, 0, -1):  # continuation counts: distinct bytes before the shorter gram
        shorter = F.col("gram").bitwiseAND(F.lit((1 << 8 * k) - 1))
        tables.append(stage(tables[-1].groupBy("lang", shorter.alias("gram")).agg(F.count(F.lit(1)).alias("n")), "grams"))
    lower = None
    for k, table in zip(range(1, ORDER + 1), reversed(tables)):
        rows = _discounted(table)
        if lower is None:
            now = rows.select("lang", "gram", (F.col("own") + F.col("back") / 256).alias("p"))
        else:
            short = F.col("gram").bitwiseAND(F.lit((1 << 8 * (k - 1)) - 1))
            now = rows.withColumn("short", short).join(lower.select("lang", F.col("gram").alias("short"), F.col("p").alias("q")),
                                                       ["lang", "short"]) \
                .select("lang", "gram", (F.col("own") + F.col("back") * F.col("q")).alias("p"))
        lower = stage(now, "probabilities") if k < ORDER else now
    return lower.select("lang", "gram", (-F.log2("p")).alias("bits"))


def _hash(keys: np.ndarray) -> np.ndarray:
    """A bijection of 32-bit numbers."""
    h = keys.astype(np.uint32)
    for shift, factor in ((16, 0x7FEB352D), (15, 0x846CA68B)):
        h = (h ^ (h >> np.uint32(shift))) * np.uint32(factor)
    return h ^ (h >> np.uint32(16))


@lru_cache(maxsize=1)
def load_model(path: str) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """Per language: sorted hashes and their bits, from the written table; once per worker."""
    from pyarrow import parquet

    fs, name = open_fs(path)
    table = parquet.read_table(name, filesystem=fs, columns=["lang", "gram", "bits"])
    out, langs = {}, table.column("lang").combine_chunks().dictionary_encode()
    code = langs.indices.to_numpy()
    hashes, bits = _hash(table.column("gram").to_numpy()), table.column("bits").to_numpy().astype(np.float32)
    for k, lang in enumerate(langs.dictionary.to_pylist()):
        h, b = hashes[code == k], bits[code == k]
        order = np.argsort(h)
        out[lang] = (h[order], b[order])
    return out


_NO_GRAMS = (np.zeros(0, np.uint32), np.zeros(0, np.float32))  # a language without a byte of text
_BASE = "uid long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def _base_rows(texts: list[str | None]) -> list[pa.Array]:
    return [pa.array(c, pa.int64()) for c in zip(*[base_counts(t) for t in texts])] if texts else [pa.array([], pa.int64())] * 5


def scored(rows: DataFrame, folder: str | None) -> DataFrame:
    """Base counts of `rows` (uid, lang, text) and, with a model folder, bits per byte."""
    def judge(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            langs, texts = part.column(1).to_pylist(), part.column(2).to_pylist()
            bits = np.full(len(texts), np.nan)
            for lang, idx in _by_language(langs, texts) if folder else ():
                hashes, value = load_model(folder).get(lang, _NO_GRAMS)
                data = [(texts[i] or "").encode() for i in idx]
                at = 0
                while at < len(idx):
                    end, size = at, 0
                    while end < len(idx) and (end == at or size + len(data[end]) < 4_000_000):
                        size += len(data[end])
                        end += 1
                    keys, sizes = _grams(data[at:end])
                    uniq, where = np.unique(keys, return_inverse=True)
                    total = np.concatenate([[0.0], np.cumsum(value[np.searchsorted(hashes, _hash(uniq))][where], dtype=np.float64)]) \
                        if len(uniq) else np.zeros(1)
                    ends = np.cumsum(sizes)
                    with np.errstate(invalid="ignore"):
                        bits[idx[at:end]] = (total[ends] - total[ends - sizes]) / sizes
                    at = end
            yield pa.RecordBatch.from_arrays([part.column(0), *_base_rows(texts), pa.array(bits, pa.float64(), from_pandas=True)],
                                             names=[*(x.split()[0] for x in _BASE.split(", ")), "bits"])

    return rows.select("uid", "lang", "text").mapInArrow(judge, _BASE + ", bits double")


def _joined_bits(rows: DataFrame, model: DataFrame) -> DataFrame:
    """Bits per byte by a join of each document's n-gram counts with the model."""
    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for uid, lang, text in zip(*(c.to_pylist() for c in part.columns)):
                keys, n = np.unique(_grams([(text or "").encode()])[0], return_counts=True)
                if len(keys):
                    yield pa.RecordBatch.from_pydict({"uid": pa.array([uid] * len(keys), pa.int64()), "lang": [lang] * len(keys),
                                                      "gram": pa.array(keys.astype(np.int64)), "n": pa.array(n.astype(np.int64))})

    grams = rows.select("uid", "lang", "text").mapInArrow(count, "uid long, lang string, gram long, n long")
    return grams.join(model, ["lang", "gram"]).groupBy("uid").agg((F.sum(F.col("n") * F.col("bits")) / F.sum("n")).alias("bits"))


def judge_quality(docs: DataFrame, spread: float = SPREAD, margin: float = MARGIN, model_bytes: int = MODEL_BYTES) -> DataFrame:
    """Per row of `docs` (doc_id, text, lang): doc_id, the base counts, base_failed,
    perplexity (per byte), its language's bands low and high, and kept."""
    spark = docs.sparkSession
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("und"))
    rows = with_uid(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), lang.alias("lang")),
                    ["doc_id", "text", "lang"])
    folder = f"{shared_folder(spark, 'kn-model')}/table"
    model_table(stage(count_grams(rows), "grams")).write.parquet(folder)
    model = spark.read.parquet(folder)
    if model.count() * 16 <= model_bytes:
        measured = stage(scored(rows, folder), "scored")
    else:
        measured = stage(scored(rows, None).drop("bits").join(_joined_bits(rows, model), "uid", "left"), "scored")
    n = F.col("n_words")
    failed = (n < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * n)
    known = measured.join(rows.select("uid", "doc_id", "lang"), "uid").withColumn("base_failed", failed)
    quartiles = known.where("NOT base_failed AND bits IS NOT NULL").groupBy("lang") \
        .agg(F.percentile_approx("bits", [0.25, 0.75], 10_000).alias("q"))
    reach = F.greatest(F.lit(margin), F.lit(spread) * (F.col("q")[1] - F.col("q")[0]))
    bands = quartiles.select("lang", F.pow(2.0, F.col("q")[0] - reach).alias("low"), F.pow(2.0, F.col("q")[1] + reach).alias("high"))
    perplexity = F.pow(F.lit(2.0), F.col("bits"))
    return known.join(_per_language(bands), "lang", "left").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & F.coalesce(perplexity.between(F.col("low"), F.col("high")), F.lit(False))).alias("kept"),
        perplexity.alias("perplexity"), "low", "high")
