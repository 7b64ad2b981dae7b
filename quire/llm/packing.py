"""Best-fit packing by a linear grouping scheme.

Pieces of at most `capacity` tokens go into as few sequences as possible:

1. large pieces (over `small_share` of the capacity) are sorted and cut into
   groups of equal cardinality; each is rounded up to the longest of its group;
2. the cutting-stock linear program over these few sizes is solved by column
   generation (a configuration is a multiset of rounded sizes that fits), and
   its solution is rounded down to whole configurations;
3. real pieces take the places: the longest piece within a place's size, and in
   a configuration's last place the longest one within the room that is really
   left, so that what rounding added is used again;
4. the pieces left over and the small ones are placed longest first, each into
   the sequence with the least room that still holds it.

Pieces are dealt to cells of about `cell_pieces` by a hash of their row id, and
each cell is packed by one task, so work and memory per task do not grow with
the table; a cell wastes at most a few sequences. Equal lengths are ties, taken
in row-id order, so a rerun packs alike.

Null or empty texts are one piece holding the end id. Rows that repeat a doc_id
are packed each on its own; a null doc_id is kept. An empty table packs to an
empty result. Other columns of the input are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import batches, frugal, stage, texts
from quire.llm.tokens import default_tokenizer, encoder

CAPACITY = 2048
GROUPS = 64
SMALL_SHARE = 1 / 3
CELL_PIECES = 50_000
_PIECES = "uid long, doc_id long, piece int, start long, length long, ids_crc32 long"


def best_fit(lengths: np.ndarray, room: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Longest first, each piece into the bin with the least sufficient room
    (a new one if none). Returns the bin of each piece and the rooms left."""
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = room.tolist()
    filled = 0  # bit r: some bin has room r
    for b in range(len(rooms) - 1, -1, -1):
        by_room[rooms[b]].append(b)
        filled |= 1 << rooms[b]
    out = np.empty(len(lengths), np.int64)
    for i in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[i])
        fitting = filled >> need
        if fitting:
            r = need + (fitting & -fitting).bit_length() - 1
            b = by_room[r].pop()
            if not by_room[r]:
                filled ^= 1 << r
        else:
            b, r = len(rooms), capacity
            rooms.append(capacity)
        rooms[b] = r = r - need
        by_room[r].append(b)
        filled |= 1 << r
        out[i] = b
    return out, np.array(rooms, np.int64)


class _Pool:
    """Pieces by length; `longest(limit)` takes one of the longest within a limit."""

    def __init__(self, pieces: np.ndarray, lengths: np.ndarray):
        self.by_length: dict[int, list[int]] = {}
        for i in pieces[::-1].tolist():
            self.by_length.setdefault(int(lengths[i]), []).append(i)
        self.present = sum(1 << n for n in self.by_length)

    def longest(self, limit: int) -> int | None:
        n = (self.present & ((2 << limit) - 1)).bit_length() - 1
        if n < 0:
            return None
        i = self.by_length[n].pop()
        if not self.by_length[n]:
            self.present ^= 1 << n
        return i


def _price(sizes: np.ndarray, duals: np.ndarray, before: np.ndarray) -> tuple[float, np.ndarray]:
    """The configuration of greatest dual value, an unbounded knapsack: `before`
    holds the capacity left when a size is put into each capacity (or -1)."""
    value = np.zeros(before.shape[1] + 1)
    value[-1] = -np.inf  # read through the index -1
    while True:
        gain = duals[:, None] + value[before]
        best = np.maximum(gain.max(axis=0), 0.0)
        if not (best > value[:-1] + 1e-12).any():
            break
        value[:-1] = np.maximum(best, value[:-1])
    counts, c = np.zeros(len(sizes), np.int64), before.shape[1] - 1
    while value[c] > 1e-12:
        g = int((duals + value[before[:, c]]).argmax())
        counts[g] += 1
        c = before[g, c]
    return float(value[-2]), counts


def configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int,
                   rounds: int = 400) -> tuple[np.ndarray, np.ndarray]:
    """Basic solution of min sum(x), A x = demand, x >= 0 over all configurations
    (columns of A), by the revised simplex method with a knapsack as pricing.
    Returns the basis' columns and their (fractional) multiplicities."""
    m = len(sizes)
    before = np.maximum(np.arange(capacity + 1)[None, :] - sizes[:, None], -1)
    per = capacity // sizes
    basis = np.diag(per).astype(float)
    inverse = np.diag(1.0 / per)
    x = demand / per
    for _ in range(rounds):
        duals = inverse.sum(axis=0)
        best, column = _price(sizes, duals, before)
        if best <= 1 + 1e-7:
            break
        d = inverse @ column
        ratio = np.full(m, np.inf)
        up = d > 1e-10
        ratio[up] = x[up] / d[up]
        leave = int(ratio.argmin())
        step = ratio[leave]
        x = np.maximum(x - step * d, 0.0)
        x[leave] = step
        basis[:, leave] = column
        inverse[leave] /= d[leave]
        others = np.arange(m) != leave
        inverse[others] -= np.outer(d[others], inverse[leave])
    return basis.astype(np.int64), x


def pack(lengths: np.ndarray, capacity: int = CAPACITY, groups: int = GROUPS,
         small_share: float = SMALL_SHARE) -> np.ndarray:
    """The bin of each piece (any dense numbering); lengths in 1 .. capacity."""
    lengths = np.asarray(lengths, np.int64)
    out = np.full(len(lengths), -1, np.int64)
    full = np.flatnonzero(lengths == capacity)
    out[full] = np.arange(len(full))
    bins = len(full)
    rest = np.flatnonzero(lengths < capacity)
    large = rest[lengths[rest] > capacity * small_share]
    large = large[np.argsort(lengths[large], kind="stable")]
    room: list[int] = []
    if len(large):
        cut = np.array_split(large, min(groups, len(large)))
        sizes, member = np.unique([lengths[g[-1]] for g in cut], return_inverse=True)
        demand = np.bincount(member, weights=[len(g) for g in cut], minlength=len(sizes))
        columns, x = configurations(sizes, demand, capacity)
        pool = _Pool(large, lengths)
        for k in np.argsort(-x, kind="stable"):
            slots = np.repeat(sizes[::-1], columns[::-1, k]).tolist()
            for _ in range(int(x[k] + 1e-6)):
                free = capacity
                for j, size in enumerate(slots):
                    last = j == len(slots) - 1
                    i = pool.longest(free if last else min(size, free))
                    if i is not None:
                        out[i] = bins + len(room)
                        free -= int(lengths[i])
                if free < capacity:
                    room.append(free)
    left = np.flatnonzero(out < 0)
    placed, _ = best_fit(lengths[left], np.array(room, np.int64), capacity)
    out[left] = placed + bins
    return out


def token_pieces(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None, end_id: int = 0) -> DataFrame:
    """One row per piece of each whole text. A document over `capacity` ids is
    cut into pieces of `capacity`; its first piece takes the remainder."""
    tokenizer = tokenizer or default_tokenizer()
    schema = pa.schema([("uid", pa.int64()), ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
                        ("length", pa.int64()), ("ids_crc32", pa.int64())])

    def cut(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        end = np.array([end_id], enc.dtype).tobytes()
        uid = TaskContext.get().partitionId() << 33
        for part in parts:
            rows: dict[str, list] = {f.name: [] for f in schema}
            for doc_id, text in zip(part.column(0).to_pylist(), texts(part.column(1))):
                ids = np.frombuffer(enc.encode(text) + end, enc.dtype).astype("<u4")
                first = len(ids) % capacity or capacity
                edges = [0, *range(first, len(ids) + 1, capacity)]
                for k, (a, b) in enumerate(zip(edges, edges[1:])):
                    for name, v in zip(rows, (uid, doc_id, k, a, b - a, zlib.crc32(ids[a:b]))):
                        rows[name].append(v)
                    uid += 1
            yield from batches(rows, schema)
        enc.forget()

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(frugal(cut), _PIECES)


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None,
                   groups: int = GROUPS, cell_pieces: int = CELL_PIECES) -> DataFrame:
    """Pieces of all documents with sequence_id and offset in the sequence."""
    pieces = stage(token_pieces(docs, capacity, tokenizer), "pieces")
    cells = max(1, round(pieces.count() / cell_pieces))

    def place(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("uid", ignore_index=True)
        bins = pack(frame["length"].to_numpy(), capacity, groups)
        order = np.lexsort((frame["uid"], bins))
        lengths = frame["length"].to_numpy()[order]
        before = np.cumsum(lengths) - lengths
        new = np.diff(bins[order], prepend=-1) != 0
        frame = frame.iloc[order]
        frame["offset"] = before - np.maximum.accumulate(np.where(new, before, 0))
        frame["sequence_id"] = frame["cell"] * (1 << 32) + bins[order]
        return frame.drop(columns=["cell", "uid"])

    return pieces.withColumn("cell", F.pmod(F.xxhash64("uid"), F.lit(cells))).groupBy("cell").applyInPandas(
        place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
