"""Repeated-substring removal: a depth-limited radix sort of suffixes.

A suffix matters only through its first `width` bytes (a window). Windows are
put into equal groups by most-significant-digit passes, each pass a shuffle on
one digit, and only groups still of more than one window go on:

digit 1, anchor: the least hashed 32-byte string inside a window. Equal windows
    have equal anchors at equal offsets. Neighbouring windows share an anchor,
    so a run of windows is one row (about one row per 70 bytes of text).
    An anchor found once: its windows are unique. The same bytes around an
    anchor twice: the whole run is repeated. Anything else goes on.
digit 2, slice: the 188 bytes common to 13 neighbouring windows of a run, at
    places fixed by the anchor. A slice found once: its windows are unique.
digit 3, the 12 bytes that tell the windows of a slice apart, carried along with
    the slice: equal groups here are exactly the repeated windows.

Each pass streams rows sorted by its digit and holds one row of an anchor's
group, or up to `group_rows` rows of a slice's group; a larger slice group is
counted by a plain distributed aggregation instead. Equal rows of a map task are
combined before the first shuffle, so a passage that many documents share sends
one row per task.

A text is its UTF-8 bytes (null: none); matches never cross documents. Rows
that repeat a doc_id are separate documents; a null doc_id is kept. Shorter
texts than `width` keep all bytes. An empty table gives an empty result. Other
columns do not matter, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import frugal, stage, texts, with_uid

WIDTH = 200
ANCHOR = 32
SLICE = 13
GROUP_ROWS = 200_000
_BASE = 0x9E3779B97F4A7C15
_ROW = "kind byte, digit long, ctx long, uid long, first int, off int, len int"


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2^64."""
    out = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        p = np.empty(n, np.uint64)
        p[0], done, step = 1, 1, base
        while done < n:
            take = min(done, n - done)
            p[done:done + take] = p[:take] * np.uint64(step)
            done, step = done + take, step * step % (1 << 64)
        out.append(p)
    return out[0], out[1]


def _sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each w neighbours, by block-wise running minima from both sides."""
    m = len(x) - w + 1
    blocks = np.concatenate([x, np.full(-len(x) % w, np.iinfo(x.dtype).max, x.dtype)]).reshape(-1, w)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:m], ahead[w - 1:w - 1 + m])


def runs(data: bytes, width: int) -> tuple[np.ndarray, ...]:
    """Of each run of windows with a common anchor: the anchor's hash and place,
    and the first and last window. Ties go to the leftmost anchor."""
    size = 1 << max(20, len(data).bit_length())
    power, inverse = _powers(size)
    span = width - ANCHOR + 1
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((np.frombuffer(data, np.uint8).astype(np.uint64) + np.uint64(1)) * power[:len(data)], out=sums[1:])
    h = (sums[ANCHOR:] - sums[:-ANCHOR]) * inverse[:len(data) - ANCHOR + 1]
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    key = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64)
    at = (_sliding_min(key, span) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    change = np.flatnonzero(np.diff(at)) + 1
    first = np.concatenate([[0], change])
    last = np.concatenate([change - 1, [len(at) - 1]])
    place = at[first]
    return h[place].view(np.int64), place, first, last


def _anchor_rows(width: int):
    def rows(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        found: list[tuple[np.ndarray, ...]] = []
        for part in parts:
            for uid, text in zip(part.column(0).to_pylist(), texts(part.column(1))):
                data = (text or "").encode()
                if len(data) < width:
                    continue
                digit, place, first, last = runs(data, width)
                ctx = np.array([xxhash.xxh3_64_intdigest(data[a:b]) for a, b in zip(first.tolist(), (last + width).tolist())],
                               np.uint64).view(np.int64)
                found.append((digit, ctx, np.full(len(digit), uid, np.int64), first, place - first, last - first))
        if not found:
            return
        digit, ctx, uid, first, off, length = (np.concatenate(x) for x in zip(*found))
        found.clear()
        order = np.lexsort((ctx, digit))
        same = (np.diff(digit[order]) == 0) & (np.diff(ctx[order]) == 0)
        starts = np.concatenate([[True], ~same])
        many = np.empty(len(order), bool)
        many[order] = np.concatenate([[False], same]) | np.concatenate([same, [False]])
        rep = np.zeros(len(order), bool)
        rep[order[starts]] = True
        # kind 0: known to be repeated, on its way to its document; 1: one row of an anchor and
        # context; 2: the same, of several in this task (those are of kind 0 too)
        send = np.flatnonzero(rep)
        settled = np.flatnonzero(many)
        f, u, e = first[settled], uid[settled], (first + length)[settled] + width
        new = np.concatenate([[True], (u[1:] != u[:-1]) | (f[1:] > e[:-1])]) if len(f) else np.zeros(0, bool)
        begin = np.flatnonzero(new)
        stop = np.concatenate([begin[1:], [len(f)]]) - 1 if len(f) else begin
        yield from _emit(np.where(many[send], 2, 1), digit[send], ctx[send], uid[send], first[send], off[send], length[send])
        if len(begin):
            zero = np.zeros(len(begin), np.int64)
            spread = u[begin] * np.int64(-7046029254386353131)
            yield from _emit(zero, spread, zero, u[begin], f[begin], zero, e[stop] - f[begin])

    return rows


def _emit(kind, digit, ctx, uid, first, off, length, size: int = 100_000) -> Iterator[pa.RecordBatch]:
    types = (("kind", pa.int8()), ("digit", pa.int64()), ("ctx", pa.int64()), ("uid", pa.int64()), ("first", pa.int32()),
             ("off", pa.int32()), ("len", pa.int32()))
    for i in range(0, len(kind), size):
        cols = [pa.array(np.asarray(c[i:i + size]).astype(t.to_pandas_dtype()), t)
                for c, (_, t) in zip((kind, digit, ctx, uid, first, off, length), types)]
        yield pa.RecordBatch.from_arrays(cols, names=[n for n, _ in types])


def _settle(width: int):
    """Rows sorted by (digit, ctx) -> kind 0: repeated bytes [first, first+len) of
    uid; kind 1: a run that goes on to the next digit. Holds one row between batches."""
    def rows(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None  # last row's columns, then: several, settled, passed on, mixed
        for part in parts:
            cols = [part.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(7)]
            ready = cols[0] == 0
            if ready.any():
                k, d, c, u, f, o, n = (x[ready] for x in cols)
                yield from _emit(k, d, c, u, f, o, n)
            cols = [x[~ready] for x in cols]
            many, done, passed = cols[0] == 2, cols[0] == 2, np.zeros(len(cols[0]), bool)
            mixed_first = False
            if held is not None:
                cols = [np.concatenate([[v], x]) for v, x in zip(held[0], cols)]
                many, done, passed = (np.concatenate([[v], x]) for v, x in zip(held[1:4], (many, done, passed)))
                mixed_first = held[4]
            kind, digit, ctx, uid, first, off, length = cols
            if not len(kind):
                continue
            new_digit = np.concatenate([[True], digit[1:] != digit[:-1]])
            new_ctx = new_digit | np.concatenate([[True], ctx[1:] != ctx[:-1]])
            d_id, c_id = np.cumsum(new_digit) - 1, np.cumsum(new_ctx) - 1
            n_ctx = np.bincount(d_id[new_ctx])
            mixed = n_ctx > 1
            mixed[0] |= mixed_first
            size = np.bincount(c_id)
            several = (size > 1) | (np.bincount(c_id, weights=many) > 0)
            out = np.flatnonzero(several[c_id] & ~done)
            zero = np.zeros(len(out), np.int64)
            yield from _emit(zero, zero, zero, uid[out], first[out], zero, length[out] + width)
            gone = np.bincount(c_id, weights=passed) > 0
            on = np.flatnonzero(new_ctx & mixed[d_id] & ~gone[c_id])
            yield from _emit(np.ones(len(on), np.int64), digit[on], ctx[on], uid[on], first[on], off[on], length[on])
            at = int(np.flatnonzero(new_ctx)[-1])
            held = ([x[at] for x in cols], bool(several[-1]), bool(several[-1]), bool(mixed[-1]), bool(mixed[-1]))

    return rows


def _slice_rows(width: int):
    """Runs of a document -> a row per slice: hash of the common bytes, the 24
    bytes around them, the place, and which of the 13 windows exist."""
    core = width - SLICE + 1

    def rows(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash
        import zstandard

        unpack = zstandard.ZstdDecompressor().decompress
        for part in parts:
            out: list[tuple] = []
            for uid, packed, found in zip(*(part.column(i).to_pylist() for i in range(3))):
                data = unpack(packed)
                for r in found:
                    anchor = r["first"] + r["off"]
                    low, high = r["off"] - r["len"], r["off"]
                    for j in range(low // SLICE, high // SLICE + 1):
                        base = anchor - j * SLICE
                        d1, d2 = max(0, low - j * SLICE), min(SLICE - 1, high - j * SLICE)
                        around = data[max(0, base - SLICE + 1):base].rjust(SLICE - 1, b"\0") \
                            + data[base + core:base + width].ljust(SLICE - 1, b"\0")
                        out.append((xxhash.xxh3_64_intdigest(data[base:base + core]) - (1 << 63), around, uid, base, d1 << 4 | d2))
            for i in range(0, len(out), 50_000):
                digit, around, uid, base, which = zip(*out[i:i + 50_000])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(digit, pa.int64()), pa.array(around, pa.binary()), pa.array(uid, pa.int64()),
                     pa.array(base, pa.int32()), pa.array(which, pa.int32())], names=["digit", "around", "uid", "base", "which"])

    return rows


_SLICES = "digit long, around binary, uid long, base int, which int"


def _repeated(digit: np.ndarray, around: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest repeated window of each slice row (or -1), among the rows given."""
    low, high = np.full(len(digit), -1), np.full(len(digit), -1)
    d1, d2 = which >> 4, which & 15
    for d in range(SLICE):
        rows = np.flatnonzero((d1 <= d) & (d <= d2))
        if len(rows) < 2:
            continue
        tell = np.ascontiguousarray(around[rows, SLICE - 1 - d:2 * (SLICE - 1) - d])
        words = tell.view("<u4").astype(np.uint64)
        key = digit[rows].view(np.uint64).copy()
        for w in range(words.shape[1]):
            key = (key ^ words[:, w]) * np.uint64(0x9FB21C651E98DF25)
            key ^= key >> np.uint64(31)
        _, group, n = np.unique(key, return_inverse=True, return_counts=True)
        hit = rows[n[group] > 1]
        low[hit] = np.where(low[hit] < 0, d, low[hit])
        high[hit] = d
    return low, high


def _windows(width: int, group_rows: int):
    """Slice rows sorted by digit -> kind 0: repeated bytes [b, e) of uid; kind 1: a
    row of a group over `group_rows`, for the distributed way."""
    schema = pa.schema([("kind", pa.int8()), ("uid", pa.int64()), ("b", pa.int32()), ("e", pa.int32()),
                        ("digit", pa.int64()), ("around", pa.binary())])

    def spans(digit, around, uid, base, which) -> Iterator[pa.RecordBatch]:
        twin = np.concatenate([[False], digit[1:] == digit[:-1]])
        keep = twin | np.concatenate([twin[1:], [False]])
        if not keep.any():
            return
        digit, uid, base, which = (x[keep] for x in (digit, uid, base, which))
        flat = np.frombuffer(b"".join(around[i] for i in np.flatnonzero(keep)), np.uint8).reshape(len(digit), -1)
        low, high = _repeated(digit, flat, which)
        hit = low >= 0
        n = int(hit.sum())
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.zeros(n, np.int8)), pa.array(uid[hit]), pa.array((base - high)[hit].astype(np.int32)),
                 pa.array((base - low)[hit].astype(np.int32) + np.int32(width)), pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary())],
                schema=schema)

    def rows(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, large = None, None
        for part in parts:
            cols = [part.column(0).to_numpy(), np.array(part.column(1).to_pylist(), object),
                    *(part.column(i).to_numpy().astype(np.int64) for i in (2, 3, 4))]
            if held is not None:
                cols = [np.concatenate([a, b]) for a, b in zip(held, cols)]
            digit = cols[0]
            if large is not None:
                end = int(np.searchsorted(digit, large, "right"))
                yield from big([x[:end] for x in cols])
                cols = [x[end:] for x in cols]
                digit = cols[0]
                if not len(digit):
                    held = None
                    continue
                large = None
            cut = int(np.searchsorted(digit, digit[-1], "left"))
            if cut:
                yield from spans(*(x[:cut] for x in cols))
            held = [x[cut:] for x in cols]
            if len(held[0]) > group_rows:
                large = digit[-1]
                yield from big(held)
                held = None
        if held is not None and len(held[0]):
            yield from spans(*held)

    def big(cols) -> Iterator[pa.RecordBatch]:
        digit, around, uid, base, which = cols
        for i in range(0, len(digit), 50_000):
            s = slice(i, i + 50_000)
            n = len(digit[s])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.ones(n, np.int8)), pa.array(uid[s]), pa.array(base[s].astype(np.int32)),
                 pa.array(which[s].astype(np.int32)), pa.array(digit[s]), pa.array(around[s].tolist(), pa.binary())], schema=schema)

    return rows


def _large_groups(rows: DataFrame, width: int) -> DataFrame:
    """Repeated windows of slice groups too large for one task: one row per window,
    counted by a partial and a final aggregation."""
    windows = rows.select(
        "uid", F.col("b").alias("base"), "digit",
        F.explode(F.sequence(F.shiftright("e", 4), F.col("e").bitwiseAND(15))).alias("d"), "around") \
        .withColumn("tell", F.expr(f"substring(around, {SLICE} - d, {SLICE - 1})"))
    twice = windows.groupBy("digit", "d", "tell").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return windows.join(twice, ["digit", "d", "tell"], "left_semi") \
        .select("uid", F.expr("base - d").alias("b"), F.expr(f"base - d + {width}").alias("e"))


def _pack_texts(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import zstandard

    press = zstandard.ZstdCompressor(level=1, write_content_size=True).compress
    for part in parts:
        packed = [press((t or "").encode()) for t in texts(part.column(1))]
        yield pa.RecordBatch.from_arrays([part.column(0), pa.array(packed, pa.binary()), *part.columns[2:]],
                                         names=["uid", "packed", *part.schema.names[2:]])


def repeated_spans(rows: DataFrame, width: int = WIDTH, group_rows: int = GROUP_ROWS) -> DataFrame:
    """(uid, spans: array of (b, e)) of the bytes covered by a repeated window,
    for `rows` (uid, text) with stable unique ids; spans may overlap."""
    spark = rows.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    anchors = rows.select("uid", "text").mapInArrow(frugal(_anchor_rows(width)), _ROW)
    settled = stage(anchors.repartition(n, "digit").sortWithinPartitions("digit", "ctx").mapInArrow(frugal(_settle(width)), _ROW)
                    .select("kind", "uid", "first", "off", "len"), "runs")
    open_runs = settled.where("kind = 1").groupBy("uid").agg(F.collect_list(F.struct("first", "off", "len")).alias("runs"))
    packed = rows.select("uid", "text").mapInArrow(frugal(_pack_texts), "uid long, packed binary")
    slices = packed.join(open_runs, "uid").select("uid", "packed", "runs").mapInArrow(frugal(_slice_rows(width)), _SLICES)
    found = stage(slices.repartition(n, "digit").sortWithinPartitions("digit").mapInArrow(
        frugal(_windows(width, group_rows)), "kind byte, uid long, b int, e int, digit long, around binary"), "windows")
    spans = settled.where("kind = 0").select("uid", F.col("first").alias("b"), F.expr("first + len").alias("e")) \
        .unionByName(found.where("kind = 0").select("uid", "b", "e"))
    large = found.where("kind = 1")
    if not large.isEmpty():
        spans = spans.unionByName(_large_groups(large, width))
    return spans.groupBy("uid").agg(F.collect_list(F.struct("b", "e")).alias("spans"))


def merged(spans: list[dict]) -> list[tuple[int, int]]:
    """Maximal runs of the union of [b, e) spans."""
    out: list[list[int]] = []
    for b, e in sorted((s["b"], s["e"]) for s in spans):
        if out and b <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([b, e])
    return [(b, e) for b, e in out]


def _cut(data: bytes, removed: list[tuple[int, int]]) -> bytes:
    edges = [0, *(x for r in removed for x in r), len(data)]
    return b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2]))


def whole_characters(data: bytes, removed: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The removed runs without characters that they cover only in part."""
    out = []
    for b, e in removed:
        while b < e and data[b] & 0xC0 == 0x80:
            b += 1
        while e > b and e < len(data) and data[e] & 0xC0 == 0x80:
            e -= 1
        if b < e:
            out.append((b, e))
    return out


def remove_repeats(docs: DataFrame, keep: list[str] | None = None, width: int = WIDTH,
                   group_rows: int = GROUP_ROWS) -> DataFrame:
    """Per row of `docs` (with a column text): its `keep` columns (default doc_id),
    then text without the characters that lie wholly in removed bytes, removed
    (array of (b, e) byte runs), n_bytes, n_removed, n_spans, kept_sha256 (of the
    remaining bytes); `keep` must not hold these names."""
    row = F.struct(*(keep or ["doc_id"])).alias("row")
    rows = with_uid(docs.select(row, F.col("text").cast("string").alias("text")), ["row", "text"])
    spans = repeated_spans(rows, width, group_rows)
    kind = rows.schema["row"].dataType.simpleString()
    packed = rows.select("uid", "text", "row").mapInArrow(frugal(_pack_texts), f"uid long, packed binary, row {kind}")

    def finish(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unpack = zstandard.ZstdDecompressor().decompress
        for part in parts:
            out: dict[str, list] = {k: [] for k in ("text", "removed", "n_bytes", "n_removed", "n_spans", "kept_sha256")}
            for blob, found in zip(part.column("packed").to_pylist(), part.column("spans").to_pylist()):
                data, removed = unpack(blob), merged(found or [])
                out["text"].append(_cut(data, whole_characters(data, removed)).decode())
                out["removed"].append([{"b": b, "e": e} for b, e in removed])
                out["n_bytes"].append(len(data))
                out["n_removed"].append(sum(e - b for b, e in removed))
                out["n_spans"].append(len(removed))
                out["kept_sha256"].append(hashlib.sha256(_cut(data, removed)).hexdigest())
            span = pa.list_(pa.struct([("b", pa.int32()), ("e", pa.int32())]))
            yield pa.RecordBatch.from_arrays(
                [part.column("row"), pa.array(out["text"], pa.string()), pa.array(out["removed"], span), *(
                    pa.array(out[k], pa.int64()) for k in ("n_bytes", "n_removed", "n_spans")), pa.array(out["kept_sha256"], pa.string())],
                names=["row", *out])

    return packed.join(spans, "uid", "left").mapInArrow(
        frugal(finish), f"row {kind}, text string, removed array<struct<b:int,e:int>>, n_bytes long, n_removed long, n_spans long, "
        "kept_sha256 string").select("row.*", "text", "removed", "n_bytes", "n_removed", "n_spans", "kept_sha256")
