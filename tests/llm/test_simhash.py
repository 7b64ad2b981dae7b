import random
import re

import numpy as np
import pytest
import xxhash

from quire.llm import simhash
from quire.llm.components import connected_components, forest


def brute_fingerprint(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    shingles = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(ids, fps, radius=3):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                root[find(i)] = find(j)
    least = {}
    for i in range(len(fps)):
        if ids[i] is not None:
            least[find(i)] = min(least.get(find(i), ids[i]), ids[i])
    return [least.get(find(i)) for i in range(len(fps))]


def texts(seed):
    r = random.Random(seed)
    words = ["".join(r.choice("abcdeE") for _ in range(r.randint(1, 6))) for _ in range(300)]
    base = [" ".join(r.choice(words) for _ in range(r.randint(1, 200))) for _ in range(120)]
    out = [None, "", " \t\n", "one", "One", "one two", "x y É", "a b c"]
    for t in base:
        out.append(t)
        w = t.split()
        for _ in range(r.randint(0, 3)):
            k = r.randrange(len(w))
            out.append(" \n".join(w[:k] + [r.choice(words)] + w[k + 1:]))
    return out + out[10:40]


@pytest.mark.parametrize("shard_rows,query_rows", [(1 << 16, 1 << 16), (16, 40)])
def test_equals_brute_force(spark, shard_rows, query_rows):
    rows = [(100 + i if i else None, t) for i, t in enumerate(texts(shard_rows))]
    rows += [(5000, "same id"), (5000, "same id")]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, uid string")
    got = simhash.near_duplicates(docs, shard_rows=shard_rows, query_rows=query_rows).collect()
    fps = [brute_fingerprint(t) for _, t in rows]
    want = list(zip([i for i, _ in rows], (f"{f:016x}" for f in fps), brute_components([i for i, _ in rows], fps)))
    key = lambda x: tuple(str(v) for v in x)
    assert sorted(((r.doc_id, r.fingerprint, r.component_id) for r in got), key=key) == sorted(want, key=key)
    assert sum(r.first for r in got) == len({w[2] for w in want})
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


@pytest.mark.parametrize("spread", [64, 12])
def test_search_finds_all_pairs(spread):
    rng = np.random.default_rng(spread)
    base = rng.integers(0, 1 << spread, 700, dtype=np.uint64) if spread < 64 else rng.integers(0, 1 << 63, 700, dtype=np.uint64)
    near = base ^ (np.uint64(1) << rng.integers(0, spread, 700).astype(np.uint64))
    x = np.unique(np.concatenate([base, near]))
    nodes = simhash.top_tree(x[::7], 3)
    idx, leaf, home = simhash.routes(x, nodes, 3)
    assert home.sum() == len(x)
    u, v = [], []
    for k in np.unique(leaf):
        a, b = simhash.search(x[idx[(leaf == k) & home]], x[idx[leaf == k]], 3)
        u.append(a)
        v.append(b)
    got = dict(zip(*(c.tolist() for c in forest(np.concatenate(u), np.concatenate(v)))))
    i, j = np.nonzero(np.triu(np.bitwise_count(x[:, None] ^ x[None, :]) <= 3, 1))
    want = dict(zip(*(c.tolist() for c in forest(x[i], x[j]))))
    assert got == want


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, i) for i in range(200, 260)] + [(400, 399), (399, 400), (5, 5)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(1, 51)} | {i: 100 for i in range(200, 260)} | {400: 399}
