"""Benchmark decontamination: CGK embedding, bit-sampling LSH, exact verification.

Texts are sequences of lower-cased words. The CGK walk turns a sequence into a
string of fixed length: at step j it writes the word it stands on and moves on
if the word's random bit for step j is 1. Sequences within a small edit distance
fall into step again after each edit, so their walks agree on most places, and
edit distance becomes Hamming distance. A key is the words at a few sampled
places (bit sampling); each benchmark item is filed under its keys, and every
window of a document as long as an item looks up its own. The number of walks and
keys is set so that an item at the largest allowed edit distance is found with
probability RECALL, measured by simulation on random edits of the items. Walks of
long items seldom stay in step, so items are searched by pieces of at most
PIECE_WORDS words: of a match within the allowed share of edits, at least one
piece is within that share too, and it is enough to find that one.

Two exact checks surround the search. Before it, windows with fewer words of the
benchmark than any match must have are left out: a match within e edits of an
item of n words holds n - e of its words. After it, each candidate is verified by
the exact edit distance of the item to the best part of the document there, and
kept if the similarity 1 - edits / words is at least SIMILARITY.

The benchmark is processed in blocks of at most BLOCK_ITEMS items, one pass over
the documents for each, so what a task holds does not grow with it. Documents
are not shuffled.

Null or empty texts and items without words match nothing. A null doc_id or
item_id is kept; repeated documents and items give a row each. Documents or
benchmarks without rows give an empty result. Other columns are not read.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import frugal

SIMILARITY = 0.8
RECALL = 0.98
SAMPLED = 3
KEYS_PER_WALK = 8
PIECE_WORDS = 100
MAX_WALKS = 512                # more than this is an error, never a lower recall
BLOCK_ITEMS = 1_000
_WORD = re.compile(r"\w+")
_MIX = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def edits(size: int, similarity: float) -> int:
    """Most edits at which an item of `size` words still counts."""
    return int((1 - similarity) * size + 1e-9)


@lru_cache(maxsize=64)
def bits(walk: int, steps: int, size: int) -> np.ndarray:
    """Random bit of each step and word id (-1 .. size-1, held at id + 1)."""
    seeds = np.array([(walk * 1_000_003 + j + 1) * int(_MIX) % (1 << 64) for j in range(steps)], np.uint64)
    ids = np.arange(size + 1, dtype=np.uint64) * _MIX
    return np.stack([(_mix(ids + seed) >> np.uint64(63)).astype(np.int8) for seed in seeds])


@lru_cache(maxsize=256)
def places(walk: int, steps: int) -> np.ndarray:
    """Sampled steps of each key of a walk, KEYS_PER_WALK x SAMPLED."""
    rng = random.Random(walk * 7919 + steps)
    return np.array([sorted(rng.sample(range(steps), min(SAMPLED, steps))) for _ in range(KEYS_PER_WALK)])


def keys(ids: np.ndarray, starts: np.ndarray, walk: int, steps: int, size: int) -> np.ndarray:
    """LSH keys of the CGK walks from all `starts` at once, KEYS_PER_WALK rows:
    hashes of the words (ids below `size`; -1: no word) at the sampled steps."""
    at, move = places(walk, steps), bits(walk, steps, size)
    padded = np.zeros(len(ids) + steps, np.int64)
    np.add(ids, 1, out=padded[:len(ids)])
    out = np.empty((KEYS_PER_WALK, len(starts)), np.uint64)
    out[:] = (np.arange(KEYS_PER_WALK, dtype=np.uint64) + np.uint64(walk * KEYS_PER_WALK + 1))[:, None]
    here = starts.copy()
    for j in range(int(at.max()) + 1):
        word = padded[here]
        for k in np.flatnonzero((at == j).any(axis=1)):
            out[k] += word.astype(np.uint64) + np.uint64(7)
            out[k] *= _MIX
            out[k] ^= out[k] >> np.uint64(29)
        here += move[j][word]
    return _mix(out)


@dataclass
class LengthClass:
    """Pieces of similar length: windows of `low` words stand for all of them."""
    low: int
    steps: int
    need: int                     # fewest benchmark words in the first `low` words of a match
    walks: int
    items: np.ndarray             # item of each key
    offsets: np.ndarray           # words of the item before the key's piece
    keys: np.ndarray              # sorted
    held: np.ndarray = field(init=False)  # whether any key has these leading bits
    shift: np.uint64 = field(init=False)

    def __post_init__(self):
        size = max(12, len(self.keys).bit_length() + 4)
        self.shift, self.held = np.uint64(64 - size), np.zeros(1 << size, bool)
        self.held[self.keys >> self.shift] = True


@dataclass
class Block:
    vocabulary: dict[str, int]
    ids: list[object] = field(default_factory=list)           # item_id
    words: list[np.ndarray] = field(default_factory=list)
    classes: list[LengthClass] = field(default_factory=list)


def _edited(ids: np.ndarray, count: int, rng: random.Random) -> np.ndarray:
    out = ids.tolist()
    for _ in range(count):
        k = rng.randrange(len(out)) if out else 0
        kind = rng.random()
        if kind < 1 / 3 and out:
            out[k] = -1
        elif kind < 2 / 3 and len(out) > 1:
            del out[k]
        else:
            out.insert(k, -1)
    return np.array(out, np.int64)


def walks_for(items: list[np.ndarray], steps: int, size: int, similarity: float, recall: float) -> int:
    """Walks at which simulated items at the largest allowed distance are found
    with probability `recall`. As in a document, a window starts at each word."""
    rng, first = random.Random(5), []
    for n in range(60):
        item = items[n % len(items)]
        other = _edited(item, edits(len(item), similarity), rng)
        hit = MAX_WALKS + 1
        for walk in range(MAX_WALKS):
            mine = keys(item, np.zeros(1, np.int64), walk, steps, size)
            theirs = keys(other, np.arange(min(3, len(other))), walk, steps, size)
            if (mine == theirs).any():
                hit = walk + 1
                break
        first.append(hit)
    first.sort()
    found = first[min(len(first) - 1, int(np.ceil(recall * len(first))) - 1)]
    if found > MAX_WALKS:
        raise ValueError(f"{MAX_WALKS} walks do not find items of {len(items[0])} words at similarity {similarity} with recall {recall}")
    return max(2, found)


def pieces(size: int) -> list[tuple[int, int]]:
    """[b, e) of the parts of nearly equal length that an item is searched by."""
    n = -(-size // PIECE_WORDS)
    cuts = [size * k // n for k in range(n + 1)]
    return list(zip(cuts, cuts[1:]))


def build_block(items: list[tuple[object, str | None]], similarity: float = SIMILARITY, recall: float = RECALL) -> Block:
    block = Block({})
    for item_id, text in items:
        found = words_of(text)
        if found:
            block.ids.append(item_id)
            block.words.append(np.array([block.vocabulary.setdefault(w, len(block.vocabulary)) for w in found], np.int64))
    parts = [(i, b, block.words[i][b:e]) for i in range(len(block.words)) for b, e in pieces(len(block.words[i]))]
    parts.sort(key=lambda x: len(x[2]))
    while parts:
        low = len(parts[0][2])
        cut = next((k for k, x in enumerate(parts) if len(x[2]) > low * 1.25), len(parts))
        mine, parts = parts[:cut], parts[cut:]
        high = len(mine[-1][2])
        steps = max(1, 2 * low - 1)
        size = len(block.vocabulary)
        walks = walks_for([x[2] for x in mine], steps, size, similarity, recall)
        table = [keys(x[2], np.zeros(1, np.int64), w, steps, size)[:, 0] for x in mine for w in range(walks)]
        flat = np.concatenate(table)
        owner, offset = (np.repeat([x[k] for x in mine], walks * KEYS_PER_WALK) for k in (0, 1))
        sort = np.argsort(flat, kind="stable")
        block.classes.append(LengthClass(low, steps, max(1, low - edits(high, similarity)), walks, owner[sort], offset[sort], flat[sort]))
    return block


def fitting_distance(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """Least edit distance of `item` to a part of `text`, and that part [b, e)."""
    row = np.zeros(len(text) + 1, np.int64)
    origin = np.arange(len(text) + 1)
    for i, w in enumerate(item.tolist()):
        up, up_origin = row + 1, origin
        swap = np.append(i + 1, row[:-1] + (text != w))
        swap_origin = np.append(0, origin[:-1])
        best = np.minimum(up, swap)
        start = np.where(swap <= up, swap_origin, up_origin)
        ahead = best - np.arange(len(best))        # insertions: a running minimum
        reach = np.minimum.accumulate(ahead)
        src = np.maximum.accumulate(np.where(ahead == reach, np.arange(len(best)), 0))
        row, origin = reach + np.arange(len(best)), start[src]
    end = int(row.argmin())
    return int(row[end]), int(origin[end]), end


def _candidates(flat: np.ndarray, c: LengthClass, size: int) -> np.ndarray:
    """(item, place of its first word, window start) of windows that share a key, sorted."""
    known = np.concatenate([[0], np.cumsum(flat >= 0)])
    starts = np.arange(len(flat) - c.low + 1 if len(flat) >= c.low else 0)
    starts = starts[(known[starts + c.low] - known[starts] >= c.need) & (flat[starts] >= 0)]
    pairs = [np.zeros((0, 3), np.int64)]
    for walk in range(c.walks if len(starts) else 0):
        found = keys(flat, starts, walk, c.steps, size).ravel()
        hit = np.flatnonzero(c.held[found >> c.shift])
        found = found[hit]
        low = np.searchsorted(c.keys, found, "left")
        count = np.searchsorted(c.keys, found, "right") - low
        at = np.repeat(starts[hit % len(starts)], count)
        nth = np.arange(len(at)) - np.repeat(np.cumsum(count) - count, count)
        key = np.repeat(low, count) + nth
        pairs.append(np.stack([c.items[key], at - c.offsets[key], at], axis=1))
    return np.unique(np.concatenate(pairs), axis=0)


def matches(texts: list[np.ndarray], block: Block, similarity: float = SIMILARITY) -> list[tuple[int, int, int, int, int]]:
    """(text, item, edits, first word, end word) of the best match of each item in
    each text (word ids, -1 for words that no item has). All texts are searched
    together, with blanks between them wide enough for any window."""
    gap = 2 * max((len(w) for w in block.words), default=0) + 4
    begins = np.cumsum([gap] + [len(t) + gap for t in texts])[:-1]
    flat = np.full(int(sum(map(len, texts))) + gap * (len(texts) + 1), -1, np.int64)
    for b, t in zip(begins.tolist(), texts):
        flat[b:b + len(t)] = t
    best: dict[tuple[int, int], tuple[int, int, int]] = {}
    place = np.full(len(block.vocabulary) + 1, -1)  # of a word among the item's distinct words
    for c in block.classes:
        pairs = _candidates(flat, c, len(block.vocabulary))
        for item in np.unique(pairs[:, 0]).tolist():
            words, (at, window) = block.words[item], pairs[pairs[:, 0] == item, 1:].T
            most = edits(len(words), similarity)
            begin, width = at - most, len(words) + 3 * most + 2
            distinct = np.unique(words)
            place[distinct] = np.arange(len(distinct))
            held = np.zeros(len(at), np.int64)
            some = max(1, min(4096, 1_000_000 // width))
            for i in range(0, len(at), some):
                there = place[flat[begin[i:i + some, None] + np.arange(width)]]
                seen = np.zeros((len(there), len(distinct) + 1), bool)
                seen[np.arange(len(there))[:, None], there] = True
                held[i:i + some] = seen[:, :-1].sum(axis=1)
            place[distinct] = -1
            fits = held >= len(distinct) - most
            done = -1
            for at_, b, there in zip(at[fits].tolist(), begin[fits].tolist(), window[fits].tolist()):
                if at_ <= done:
                    continue  # the last match covers this place
                k = int(np.searchsorted(begins, there, "right")) - 1
                lo, hi = max(b, int(begins[k])), min(b + width, int(begins[k]) + len(texts[k]))
                d, x, y = fitting_distance(words, flat[lo:hi])
                if d <= most:
                    spot = (d, lo + x - int(begins[k]), lo + y - int(begins[k]))
                    best[k, item] = min(best.get((k, item), spot), spot)
                    done = at_ + most
    return [(*ki, *v) for ki, v in best.items()]


def _chunks(texts: list[str | None], chars: int = 4_000_000) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about `chars` characters together."""
    i, size = 0, 0
    for j, t in enumerate(texts):
        size += len(t or "")
        if size >= chars or j == len(texts) - 1:
            yield i, j + 1
            i, size = j + 1, 0


_MATCH = "uid long, doc_id long, item_id long, edits int, similarity double, first_word int, end_word int"


def contaminated(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL,
                 block_items: int = BLOCK_ITEMS) -> DataFrame:
    """One row per document and benchmark item it holds: uid (if `docs` has it, else
    null), doc_id, item_id, edits, similarity and the words [first_word, end_word)
    of the best match. `docs` has doc_id and text, `benchmark` item_id and text."""
    spark = docs.sparkSession
    uid = F.col("uid").cast("long") if dict(docs.dtypes).get("uid") == "bigint" else F.lit(None).cast("long")
    rows = docs.select(uid.alias("uid"), F.col("doc_id").cast("long"), F.col("text").cast("string"))
    schema = pa.schema([("uid", pa.int64()), ("doc_id", pa.int64()), ("item_id", pa.int64()), ("edits", pa.int32()),
                        ("similarity", pa.float64()), ("first_word", pa.int32()), ("end_word", pa.int32())])

    def passed(block: Block):
        def scan(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            number = block.vocabulary.get
            for part in parts:
                uids, doc_ids, texts = (c.to_pylist() for c in part.columns)
                for i, j in _chunks(texts):
                    ids = [np.fromiter(map(number, words_of(t), repeat(-1)), np.int64) for t in texts[i:j]]
                    out = [{"uid": uids[i + k], "doc_id": doc_ids[i + k], "item_id": block.ids[item], "edits": d,
                            "similarity": 1 - d / len(block.words[item]), "first_word": b, "end_word": e}
                           for k, item, d, b, e in matches(ids, block, similarity)]
                    if out:
                        yield pa.RecordBatch.from_pylist(out, schema=schema)

        return rows.mapInArrow(frugal(scan), _MATCH)

    result, held = spark.createDataFrame([], _MATCH), []
    items = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).toLocalIterator()
    for r in items:
        held.append((r["item_id"], r["text"]))
        if len(held) == block_items:
            result, held = result.unionByName(passed(build_block(held, similarity, recall))), []
    if held:
        result = result.unionByName(passed(build_block(held, similarity, recall)))
    return result
