import hashlib
import random
from collections import Counter

import pytest

from quire.llm import repeats
from quire.llm.common import with_uid

W = repeats.WIDTH


def brute(texts):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i:i + W] for d in data for i in range(len(d) - W + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - W + 1):
            if seen[d[i:i + W]] > 1:
                gone[i:i + W] = b"\1" * W
        runs = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        kept = bytes(b for b, g in zip(d, gone) if not g)
        out.append((len(d), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def corpus(seed):
    r = random.Random(seed)
    words = ["".join(r.choice("abcdeéß") for _ in range(r.randint(1, 6))) for _ in range(60)]
    text = lambda n: " ".join(r.choice(words) for _ in range(n))
    shared = [text(r.randint(40, 120)) for _ in range(6)]
    out = [None, "", "x" * (W - 1), "x" * W, "ab" * 400, "ab" * 150, "é" * 300]
    for _ in range(60):
        parts = [text(r.randint(1, 120))]
        for _ in range(r.randint(0, 3)):
            s = r.choice(shared)
            a = r.randint(0, 60)
            parts += [s[a:a + r.randint(150, 420)], text(r.randint(0, 60))]
        out.append(" ".join(parts))
    return out + out[20:30] + [out[25]] * 20


@pytest.mark.parametrize("group_rows", [repeats.GROUP_ROWS, 3])
@pytest.mark.parametrize("files", [1, 7])
def test_equals_brute_force(spark, scratch, group_rows, files):
    texts = corpus(files)
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(files) \
        .write.parquet(f"{scratch}/docs")
    got = repeats.remove_repeats(spark.read.parquet(f"{scratch}/docs"), group_rows=group_rows).collect()
    assert len(got) == len(texts)
    want = brute(texts)
    for r in got:
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == want[r.doc_id], r.doc_id
        assert all(c in (texts[r.doc_id] or "") for c in r.text)


def test_nulls_repeats_extra_columns_and_empty(spark):
    long = " ".join(str(i) for i in range(200))
    docs = spark.createDataFrame([(None, long, 1, "k"), (7, long, 2, "k"), (7, long, 2, "k"), (8, None, 3, None)],
                                 "doc_id long, text string, uid long, digit string")
    got = sorted((r.doc_id or -1, r.n_removed, r.text) for r in repeats.remove_repeats(docs).collect())
    assert got == [(-1, len(long), ""), (7, len(long), ""), (7, len(long), ""), (8, 0, "")]
    assert repeats.remove_repeats(docs.limit(0)).count() == 0


def test_row_ids_are_stable_for_shuffled_frames(spark):
    rows = with_uid(spark.range(100).repartition(5).selectExpr("id", "string(id) text"), ["id", "text"])
    assert rows.collect() == rows.collect()
    assert rows.select("uid").distinct().count() == 100


def test_row_ids_do_not_depend_on_the_number_of_cores(spark, scratch):
    path = f"{scratch}/seven files"
    spark.range(1000).selectExpr("id", "string(id) text").repartition(7).write.parquet(path)
    before = spark.conf.get("spark.sql.leafNodeDefaultParallelism", None)
    seen = []
    try:
        for cores in ("8", "2"):
            spark.conf.set("spark.sql.leafNodeDefaultParallelism", cores)
            df = spark.read.parquet(path)
            seen.append([sorted(map(tuple, with_uid(x, ["id", "text"]).collect())) for x in (df, df.where("id % 3 > 0"))])
    finally:
        spark.conf.unset("spark.sql.leafNodeDefaultParallelism") if before is None else \
            spark.conf.set("spark.sql.leafNodeDefaultParallelism", before)
    assert seen[0] == seen[1] and len({r[2] for r in seen[0][0]}) == 1000 and len(seen[0][1]) == 666
    twice = with_uid(spark.read.parquet(path).selectExpr("id", "explode(array(1, 2)) AS text"), ["id", "text"])
    assert twice.select("uid").distinct().count() == 2000 and twice.collect() == twice.collect()
    assert with_uid(spark.read.parquet(path).limit(0), ["id"]).count() == 0


def test_stages_survive_another_number_of_cores(spark, scratch, monkeypatch):
    """A lost or added executor between two jobs: the default parallelism is another one after each staged table."""
    import corpus_pipeline
    from quire.llm import common, repeats, simhash

    rng = random.Random(8)
    words = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(400)]
    shared = " ".join(rng.choice(words) for _ in range(60))
    rows = [(i, " ".join(rng.choice(words) for _ in range(80)) + (shared if i % 5 == 0 else ""), "en", "s", 1) for i in range(300)]
    rows += [(1000 + i, rows[i][1], "en", "s", 1) for i in range(0, 300, 7)]
    path = f"{scratch}/docs"
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(7).write.parquet(path)
    docs = lambda: spark.read.parquet(path)
    jobs = {"near": lambda: corpus_pipeline.simhash_near_dedup(spark, docs(), ""),
            "repeats": lambda: repeats.remove_repeats(docs()).select("doc_id", "n_removed", "n_spans", "kept_sha256")}
    want = {name: sorted(map(tuple, job().collect())) for name, job in jobs.items()}
    assert 0 < len(want["near"]) <= 300
    real, turns = common.stage, iter(range(10**6))

    def shaken(df, name):
        out = real(df, name)
        spark.conf.set("spark.sql.leafNodeDefaultParallelism", "2" if next(turns) % 2 else "8")
        return out

    for module in (common, repeats, simhash, corpus_pipeline):
        monkeypatch.setattr(module, "stage", shaken)
    try:
        assert {name: sorted(map(tuple, job().collect())) for name, job in jobs.items()} == want
    finally:
        spark.conf.unset("spark.sql.leafNodeDefaultParallelism")
