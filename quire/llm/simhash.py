"""SimHash near-duplicates by vantage-point trees.

Every whole text gets a 64-bit fingerprint; fingerprints within `radius` bits are
linked, and linked ones form a component.

Search: the distinct fingerprints are partitioned by Hamming distance. A tree
over a bounded sample (at most SAMPLE_MAX fingerprints) splits at the median
distance from a vantage point; its leaves are shards. Every fingerprint lives in
one shard and is queried against each shard that its ball of `radius` bits
reaches by the triangle bound |d(q, v) - d(x, v)| <= d(q, x), so fingerprints
near a boundary go to the shards on both sides. Inside a shard the search goes
down a tree over all its fingerprints, with the same bound, to small leaves that
are compared exactly. No pair within `radius` bits is lost, and no pair is
emitted as such: a task returns at most one edge per fingerprint that links the
same ones, and components are formed by distributed star rounds.

A shard with many fingerprints or queries is cut into blocks, and each pair of
blocks is one task, so memory per task is bounded whatever the distribution.

A null, empty or blank text has fingerprint zero, linked like any other. Copies
share a fingerprint and cost one row in the search. The component id is the
smallest doc_id of the component (a null doc_id counts only if there is no
other); rows that repeat a doc_id are separate rows. An empty table gives an
empty result. Other columns do not matter, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import frugal, stage, texts, with_uid
from quire.llm.components import connected_components, forest

SHINGLE = 3
RADIUS = 3
SEED = 42
SHARD_ROWS = 1 << 16
QUERY_ROWS = 1 << 16
SAMPLE_MAX = 1 << 20
SAMPLE_PER_SHARD = 256
LEAF = 64
COUNT_ROWS = 1 << 17


def shingle_hashes(text: str | None, shingle: int) -> np.ndarray:
    """XXH64 of the space-joined shingles of the lower-cased (A-Z) words."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    k = min(shingle, len(words))
    spans = zip(starts[:len(words) - k + 1].tolist(), ends[k - 1:].tolist())
    return np.array([xxh64_intdigest(joined[a:b], SEED) for a, b in spans], np.uint64)


def fingerprint(hashes: np.ndarray) -> int:
    """Bit i is 1 if it is set in over half the hashes."""
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), COUNT_ROWS):
        part = hashes[i:i + COUNT_ROWS].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = ones * 2 > len(hashes)
    return int(np.packbits(bits, bitorder="little").view(np.uint64)[0])


def fingerprints(rows: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(uid, doc_id, fp) of `rows` (uid, doc_id, text); fp as a signed long."""
    def sign(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            fps = np.array([fingerprint(shingle_hashes(t, shingle)) for t in texts(part.column(2))], np.uint64)
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(fps.view(np.int64))],
                                             names=["uid", "doc_id", "fp"])

    return rows.select("uid", "doc_id", "text").mapInArrow(frugal(sign), "uid long, doc_id long, fp long")


def distance(x: np.ndarray, v: np.uint64) -> np.ndarray:
    return np.bitwise_count(x ^ v)


def vantage_point(x: np.ndarray, tries: int = 8) -> np.uint64:
    """Of a few fingerprints, the one from which distances to the others spread most."""
    some = x[:: max(1, len(x) // 256)][:256]
    picks = x[:: max(1, len(x) // tries)][:tries]
    return picks[int(np.argmax([distance(some, v).std() for v in picks]))]


def top_tree(sample: np.ndarray, depth: int) -> list[tuple | None]:
    """Nodes in heap order: (vantage point, largest distance inside), None for leaves."""
    nodes: list[tuple | None] = [None] * ((2 << depth) - 1)

    def split(x: np.ndarray, at: int, level: int) -> None:
        if level == depth or len(x) < 4:
            return
        v = vantage_point(x)
        d = distance(x, v)
        mid = int(np.median(d))
        if (d <= mid).all():
            mid -= 1
        inside = d <= mid
        if not inside.any():
            return
        nodes[at] = (int(v), mid)
        split(x[inside], 2 * at + 1, level + 1)
        split(x[~inside], 2 * at + 2, level + 1)

    split(sample, 0, 0)
    return nodes


def routes(x: np.ndarray, nodes: list[tuple | None], radius: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index, leaf, home): the shards that each ball of `radius` reaches, and its own."""
    out = []
    todo = [(0, np.arange(len(x)), np.ones(len(x), bool))]
    while todo:
        at, idx, home = todo.pop()
        if not len(idx):
            continue
        if at >= len(nodes) or nodes[at] is None:
            out.append((idx, np.full(len(idx), at), home))
            continue
        v, mid = nodes[at]
        d = distance(x[idx], np.uint64(v)).astype(np.int64)
        near, far = d <= mid + radius, d > mid - radius
        todo.append((2 * at + 1, idx[near], home[near] & (d <= mid)[near]))
        todo.append((2 * at + 2, idx[far], home[far] & (d > mid)[far]))
    return tuple(np.concatenate(c) for c in zip(*out)) if out else (np.zeros(0, int),) * 3


def search(data: np.ndarray, queries: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges joining all (data, query) pairs within `radius`, by a tree over `data`."""
    found: list[tuple[np.ndarray, np.ndarray]] = []
    held = 0
    todo = [(data, queries)]
    while todo:
        x, q = todo.pop()
        if not len(x) or not len(q):
            continue
        inside = None
        if len(x) > LEAF:
            v = vantage_point(x)
            d = distance(x, v)
            mid = int(np.median(d))
            inside = d <= mid
            if inside.all():
                inside = d < mid
        if inside is not None and inside.any():
            dq = distance(q, v).astype(np.int64)
            todo.append((x[inside], q[dq <= int(d[inside].max()) + radius]))
            todo.append((x[~inside], q[dq >= int(d[~inside].min()) - radius]))
            continue
        for i in range(0, len(x), LEAF):
            for j in range(0, len(q), 1 << 14):
                near = np.bitwise_count(x[i:i + LEAF, None] ^ q[None, j:j + (1 << 14)]) <= radius
                a, b = np.nonzero(near)
                a, b = x[i:i + LEAF][a], q[j:j + (1 << 14)][b]
                apart = a != b
                if apart.any():
                    found.append((a[apart], b[apart]))
                    held += len(found[-1][0])
                if held > 1 << 20:
                    found = [forest(*(np.concatenate(c) for c in zip(*found)))]
                    held = len(found[0][0])
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    return forest(*(np.concatenate(c) for c in zip(*found)))


def links(distinct: DataFrame, n: int, radius: int = RADIUS, shard_rows: int = SHARD_ROWS,
          query_rows: int = QUERY_ROWS) -> DataFrame:
    """(u, v) edges joining all of `distinct` (fp, `n` rows) within `radius` bits."""
    depth = max(0, int(np.ceil(np.log2(max(1, n / shard_rows)))))
    size = min(SAMPLE_MAX, SAMPLE_PER_SHARD << depth)
    nodes: list[tuple | None] = [None]
    if depth:
        sample = distinct.select("fp").orderBy(F.xxhash64("fp")).limit(size).toPandas()["fp"].to_numpy(np.int64)
        nodes = top_tree(sample.view(np.uint64), depth)

    def route(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            fp = part.column(0).to_numpy()
            idx, leaf, home = routes(fp.view(np.uint64), nodes, radius)
            yield pa.RecordBatch.from_arrays(
                [pa.array(leaf.astype(np.int64)), pa.array(fp[idx]), pa.array(home)], names=["leaf", "fp", "home"])

    routed = stage(distinct.select("fp").mapInArrow(route, "leaf long, fp long, home boolean"), "routed")
    blocks = F.broadcast(routed.groupBy("leaf").agg(  # one row per shard
        F.ceil(F.count_if("home") / shard_rows).cast("int").alias("a"),
        F.ceil(F.count(F.lit(1)) / query_rows).cast("int").alias("b")))
    own = F.expr("int(pmod(xxhash64(fp), a))")
    ask = F.expr("int(pmod(xxhash64(fp, 1), b))")
    sized = routed.join(blocks, "leaf").where("a > 0")
    data = sized.where("home").select("leaf", own.alias("i"), F.explode(F.expr("sequence(0, b - 1)")).alias("j"), "fp", F.lit(True).alias("home"))
    asks = sized.select("leaf", F.explode(F.expr("sequence(0, a - 1)")).alias("i"), ask.alias("j"), "fp", F.lit(False).alias("home"))

    def compare(table: pa.Table) -> pa.Table:
        fp, home = table.column("fp").to_numpy().view(np.uint64), table.column("home").to_numpy()
        u, v = search(fp[home], fp[~home], radius)
        return pa.table({"u": u.view(np.int64), "v": v.view(np.int64)})

    return data.unionByName(asks).groupBy("leaf", "i", "j").applyInArrow(compare, "u long, v long")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, shard_rows: int = SHARD_ROWS,
                    query_rows: int = QUERY_ROWS, uid: str | None = None) -> DataFrame:
    """Per row of `docs` (doc_id, text): uid, doc_id, fingerprint (hex), component_id
    and first (true for one row of each component, one with the smallest doc_id).
    `uid` names a column of unique stable longs; without it rows are numbered."""
    picked = [F.col("doc_id").cast("long"), F.col("text").cast("string")]
    rows = docs.select(F.col(uid).alias("uid"), *picked) if uid else with_uid(docs.select(*picked), ["doc_id", "text"])
    signed = stage(fingerprints(rows, shingle), "fingerprints")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "uid")
    distinct = stage(signed.groupBy("fp").agg(F.min(place).alias("least")), "distinct")
    joined = connected_components(links(distinct, distinct.count(), radius, shard_rows, query_rows))
    # classes that are linked to others: members, then their least row
    member = joined.select(F.col("node").alias("fp"), "root").unionByName(
        joined.select(F.col("root").alias("fp"), "root").distinct())
    linked = member.join(distinct, "fp")
    lowest = linked.groupBy("root").agg(F.min("least").alias("lowest"))
    class_of = linked.join(lowest, "root").select("fp", "lowest")
    classes = distinct.join(class_of, "fp", "left").select("fp", F.coalesce("lowest", "least").alias("lowest"))
    return signed.join(classes, "fp").select(
        "uid", "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("lowest.doc_id").alias("component_id"), (F.col("uid") == F.col("lowest.uid")).alias("first"))
