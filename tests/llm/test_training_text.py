"""Packing, token files, language-model rules and classifiers against brute force."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from quire.llm import kn_quality, kn_words, packing, pu_quality, token_files, toxicity
from quire.llm.elias_fano import EliasFano
from quire.llm.labelled import held_out
from quire.llm.tokens import WordEncoder, default_tokenizer

TEXTS = [None, "", " ", "a", "  two  blanks ", "don't can't o'neil's", "x\n\n  y \t z", "naïve café über ß Łódź", "中文 字 mixed中",
         "a<|endoftext|>b <|endoftext|>", "1,234.5 (x) $$$ ***", "tab\tsep\u00a0nbsp\u2003em", "e\u0301 combining", "word\x1cfoo \x1cbar",
         "UPPER lower Mixed. Punct,; end!?", "long " * 3000, "Straße" * 500, "²³ Ⅷ ½ 3rd", "\r\nwin\r\n lines \r\n"]


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(default_tokenizer())
    t.encode_special_tokens = True
    return t


def texts(seed, n=120):
    r = random.Random(seed)
    chars = "abcdeé .,!\n\t'0ÉZ中"
    return TEXTS + ["".join(r.choice(chars) for _ in range(r.randint(0, 300))) for _ in range(n)]


def ids_of(tokenizer, text):
    return np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [0], "<u4")


def test_word_cache_gives_the_librarys_ids(tokenizer):
    enc = WordEncoder(default_tokenizer())
    for t in texts(1, 600):
        assert np.frombuffer(enc.encode(t), enc.dtype).tolist() == ids_of(tokenizer, t)[:-1].tolist(), repr(t)


@pytest.mark.parametrize("values", [[], [0], [5], [0, 0, 0], [3, 3, 9, 1000], list(range(0, 9000, 3)), [2**40, 2**40 + 1]])
def test_elias_fano_round_trip(values):
    e, end = EliasFano.from_bytes(EliasFano.encode(np.array(values, np.uint64)).to_bytes())
    assert e.slice(0, len(values)).tolist() == values
    assert [e[i] for i in range(0, len(values), 97)] == values[::97]


def test_token_files(spark, tokenizer):
    rows = [(i if i != 3 else None, t, "x") for i, t in enumerate(texts(2))] + [(7, "again", "x"), (7, "again", "x"), (-5, "first", "x")]
    got = sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in
                 token_files.token_table(spark.createDataFrame(rows, "doc_id long, text string, start string")).collect())
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    want = Counter((r[0], len(ids_of(tokenizer, r[1])), zlib.crc32(ids_of(tokenizer, r[1]))) for r in order)
    assert Counter((d, n, c) for _, d, n, c in got) == want
    assert [d for _, d, _, _ in got] == [r[0] for r in order]
    assert [s for s, *_ in got] == [0, *np.cumsum([n for _, _, n, _ in got])[:-1].tolist()]
    assert token_files.token_table(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_packing_keeps_every_piece(spark, tokenizer):
    rows = [(i if i != 3 else None, t) for i, t in enumerate(texts(3))] + [(7, "again"), (7, "again")]
    got = packing.pack_documents(spark.createDataFrame(rows, "doc_id long, text string"), capacity=64, cell_pieces=60).collect()
    want = Counter()
    for d, t in rows:
        ids = ids_of(tokenizer, t)
        first = len(ids) % 64 or 64
        edges = [0, *range(first, len(ids) + 1, 64)]
        want.update((d, k, a, b - a, zlib.crc32(ids[a:b])) for k, (a, b) in enumerate(zip(edges, edges[1:])))
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    bins = defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for pieces in bins.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 64
    assert packing.pack_documents(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("low,high", [(1, 2048), (1, 700), (600, 2048), (2048, 2048), (1, 1)])
def test_packing_is_near_the_bound(low, high):
    rng = np.random.default_rng(low + high)
    lengths = rng.integers(low, high + 1, 3000)
    bins = packing.pack(lengths)
    load = np.bincount(bins, weights=lengths)
    assert load.max() <= 2048 and load.min() > 0
    bound = max(-(-int(lengths.sum()) // 2048), int((lengths > 1024).sum()))
    assert len(load) <= 1.06 * bound + 2
    assert len(packing.pack(np.zeros(0, int))) == 0


def brute_base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    count = Counter(windows)
    covered = {j for i, w in enumerate(windows) if count[w] > 1 for j in range(i, i + 3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)] if words else []
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)) if words else 0,
            len(lines) - len(set(lines)), len(covered))


def brute_bits(rows):
    """Interpolated modified Kneser-Ney over bytes, from dictionaries."""
    by_lang = defaultdict(list)
    for lang, t in rows:
        by_lang[lang or "und"].append((t or "").encode().replace(b"\0", b"\1"))
    out = {}
    for lang, data in by_lang.items():
        counts = [Counter()] * 5
        counts[4] = Counter((b"\0\0\0" + d)[i:i + 4] for d in data for i in range(len(d)))
        for k in (3, 2, 1):
            counts[k] = Counter(g[1:] for g in counts[k + 1])

        disc, total, freed = {}, {}, {}
        for k in (1, 2, 3, 4):
            n = Counter(counts[k].values())
            y = n[1] / (n[1] + 2 * n[2]) if n[1] + 2 * n[2] else 0
            d = [j - (j + 1) * y * n[j + 1] / n[j] if n[1] and n[2] and n[j] else -1 for j in (1, 2, 3)]
            disc[k] = [x if 0 < x < j else 0.5 for j, x in zip((1, 2, 3), d)]
            total[k], freed[k] = Counter(), Counter()
            for g, c in counts[k].items():
                total[k][g[:-1]] += c
                freed[k][g[:-1]] += disc[k][min(c, 3) - 1]

        def p(g):
            k = len(g)
            if not k:
                return 1 / 256
            c = counts[k][g]
            return (c - disc[k][min(c, 3) - 1]) / total[k][g[:-1]] + freed[k][g[:-1]] / total[k][g[:-1]] * p(g[1:])

        for d in data:
            padded = b"\0\0\0" + d
            out[lang, d] = sum(-math.log2(p(padded[i:i + 4])) for i in range(len(d))) / len(d) if d else None
    return out


@pytest.mark.parametrize("model_bytes", [kn_quality.MODEL_BYTES, 0])
def test_language_model_rules(spark, model_bytes):
    r = random.Random(9)
    words = ["".join(r.choice("abcde") for _ in range(r.randint(1, 5))) for _ in range(50)]
    prose = [" ".join(r.choice(words) for _ in range(r.randint(20, 150))) for _ in range(40)]
    rows = [(i, t, ["en", "fr", None][i % 3]) for i, t in enumerate(texts(4, 20) + prose + ["q#z$x " * 5 + " ".join("xyz#%&" * 9 + str(i) for i in range(70))])]
    rows += [(None, "same words here", "en"), (5, prose[0], "de"), (5, prose[0], "de")]
    got = kn_quality.judge_quality(spark.createDataFrame([(*x, 1) for x in rows], "doc_id long, text string, lang string, bits int"),
                                   model_bytes=model_bytes).collect()
    bits = brute_bits([(x[2], x[1]) for x in rows])
    want = Counter()
    for d, t, lang in rows:
        base = brute_base(t)
        b = bits[lang or "und", (t or "").encode().replace(b"\0", b"\1")]
        want[(d, *base, base[0] < 50 or 100 * base[4] > 50 * base[0], None if b is None else round(2**b, 3))] += 1
    assert Counter((x.doc_id, x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat_words, x.base_failed,
                    None if x.perplexity is None else round(x.perplexity, 3)) for x in got) == want
    for x in got:
        assert x.kept == (not x.base_failed and x.low <= x.perplexity <= x.high)
    assert any(x.kept for x in got)
    assert kn_quality.judge_quality(spark.createDataFrame([], "doc_id long, text string, lang string")).count() == 0


@pytest.mark.parametrize("model_bytes", [kn_quality.MODEL_BYTES, 0])
def test_language_with_only_empty_texts(spark, model_bytes):
    rows = [(1, "a few words of text " * 3, "en"), (2, "", "xx"), (3, None, "xx"), (4, None, None)]
    for some in (rows, rows[1:]):
        docs = spark.createDataFrame(some, "doc_id long, text string, lang string")
        got = {x.doc_id: x for x in kn_quality.judge_quality(docs, model_bytes=model_bytes).collect()}
        assert set(got) == {x[0] for x in some}
        assert all(got[d].perplexity is None and got[d].base_failed and not got[d].kept for d in (2, 3, 4))


def brute_word_bits(rows):
    """Interpolated modified Kneser-Ney over words; each fold judged by the other's model."""
    by_lang = defaultdict(set)
    for lang, t in rows:
        by_lang[lang or "und"].add((t or "").encode())
    times = Counter((lang or "und", (t or "").encode()) for lang, t in rows)
    out = {}
    grams = lambda d: list(zip([b"", b"", *d.split()], [b"", *d.split()], d.split()))
    for lang, data in by_lang.items():
        for fold in (0, 1):
            counts = {3: Counter()}
            for d in data:
                if zlib.crc32(d) % 2 != fold:
                    for g in grams(d):
                        counts[3][g] += times[lang, d]
            for k in (2, 1):
                counts[k] = Counter(g[1:] for g in counts[k + 1])
            disc, total, freed = {}, {}, {}
            for k in (1, 2, 3):
                n = Counter(counts[k].values())
                y = n[1] / (n[1] + 2 * n[2]) if n[1] + 2 * n[2] else 0
                x = [j - (j + 1) * y * n[j + 1] / n[j] if n[1] and n[2] and n[j] else -1 for j in (1, 2, 3)]
                disc[k] = [v if 0 < v < j else 0.5 for j, v in zip((1, 2, 3), x)]
                total[k], freed[k] = Counter(), Counter()
                for g, c in counts[k].items():
                    total[k][g[:-1]] += c
                    freed[k][g[:-1]] += disc[k][min(c, 3) - 1]

            def p(g):
                k = len(g)
                if not k:
                    return 1 / (len(counts[1]) + 1)
                if not total[k][g[:-1]]:
                    return p(g[1:])
                c = counts[k][g]
                return (c - (disc[k][min(c, 3) - 1] if c else 0) + freed[k][g[:-1]] * p(g[1:])) / total[k][g[:-1]]

            for d in data:
                if zlib.crc32(d) % 2 == fold:
                    out[lang, d] = sum(-math.log2(p(g)) for g in grams(d)) / len(grams(d)) if grams(d) else None
    return out


def test_word_model_rules(spark):
    r = random.Random(11)
    words = ["".join(r.choice("abcde") for _ in range(r.randint(1, 5))) for _ in range(50)]
    prose = [" ".join(r.choice(words) for _ in range(r.randint(20, 150))) for _ in range(40)]
    rows = [(i, t, ["en", "fr", None][i % 3]) for i, t in enumerate(texts(4, 20) + prose)]
    rows += [(None, "same words here", "en"), (5, prose[0], "de"), (5, prose[0], "de"), (6, "", "xx"), (7, None, "xx")]
    got = kn_words.judge_words(spark.createDataFrame([(*x, 1) for x in rows], "doc_id long, text string, lang string, bits int")).collect()
    bits = brute_word_bits([(x[2], x[1]) for x in rows])
    want = Counter()
    for d, t, lang in rows:
        base = brute_base(t)
        b = bits[lang or "und", (t or "").encode()]
        want[(d, *base, base[0] < 50 or 100 * base[4] > 50 * base[0], None if b is None else round(b, 4))] += 1
    assert Counter((x.doc_id, x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat_words, x.base_failed,
                    None if x.perplexity is None else round(math.log2(x.perplexity), 4)) for x in got) == want
    for x in got:
        assert x.kept == (not x.base_failed and x.low <= x.perplexity <= x.high)
    assert any(x.kept for x in got)
    assert kn_words.judge_words(spark.createDataFrame([], "doc_id long, text string, lang string")).count() == 0


def test_word_bands_are_quantiles(spark):
    r = random.Random(13)
    prose = [" ".join(f"w{int(300 * r.random() ** 2)}" for _ in range(100)) for _ in range(201)]
    docs = spark.createDataFrame(list(enumerate(prose)), "doc_id long, text string").selectExpr("*", "'en' AS lang")
    for low, high in ((0.0, 1.0), (0.1, 0.8), (kn_words.LOW, kn_words.HIGH)):
        got = kn_words.judge_words(docs, low, high).collect()
        ranked = sorted(x.perplexity for x in got)
        assert abs(sum(p < got[0].low for p in ranked) - low * 201) <= 1 and abs(sum(p > got[0].high for p in ranked) - (1 - high) * 201) <= 1
        assert sum(x.kept for x in got) == sum(got[0].low <= p <= got[0].high for p in ranked)


def test_word_order_counts(spark, scratch):
    """Texts of the same words in a scrambled order are less likely, and the model grows with the texts."""
    from quire.llm.registry import QUERIES

    r = random.Random(12)
    phrases = [" ".join(f"w{r.randrange(300)}" for _ in range(6)) for _ in range(60)]
    prose = [" ".join(r.choice(phrases) for _ in range(20)) for _ in range(80)]
    scrambled = [" ".join(r.sample(t.split(), 120)) for t in prose[:4]]
    docs = spark.createDataFrame(list(enumerate(prose + scrambled)), "doc_id long, text string").selectExpr("*", "'en' AS lang")
    docs.write.parquet(f"{scratch}/documents.parquet")
    got = {x.doc_id: x.perplexity for x in QUERIES["op7_quality_rules"](spark, scratch).collect()}
    assert min(got[80 + k] for k in range(4)) > 4 * max(got[k] for k in range(80))
    few, all_ = (kn_words.count_words(docs.where(f"doc_id >= 80 AND doc_id < {n}")).count() for n in (82, 84))
    assert all_ > 1.8 * few


def test_word_model_shuffles_little(spark, scratch):
    """Trigrams travel in compressed blocks, not as rows: few bytes a word, and none are left behind."""
    r = random.Random(14)
    prose = [" ".join(f"w{int(3000 * r.random() ** 3)}" for _ in range(400)) for _ in range(500)]
    spark.createDataFrame(list(enumerate(prose)), "uid long, text string").selectExpr("*", "'en' AS lang").write.parquet(f"{scratch}/rows")
    rows = spark.read.parquet(f"{scratch}/rows")
    for by_document in (False, True):
        sent = [kn_words._blocks(rows, 4, 2, k, by_document).count() for k in (0, 1)]
        size = sum(kn_words._blocks(rows, 4, 2, k, by_document).selectExpr("sum(length(block))").first()[0] for k in (0, 1))
        assert sum(sent) <= 4 * rows.rdd.getNumPartitions() and size < 10 * 400 * 500  # a row of a trigram had 48 bytes


def test_words_of_any_blanks_and_lengths():
    """Words against bytes.split, with blanks at the ends, other control characters and long words."""
    r = random.Random(15)
    parts = ["a", "ab", "x" * 8, "x" * 9, "y" * 64, "y" * 65, "y" * 200, "\x1c", "\x00", "\u00a0", "\u20ac", *" \t\n\x0b\x0c\r"]
    held = ["".join(r.choice(parts) for _ in range(r.randint(0, 30))).encode() for _ in range(300)] + [b"", b" ", b"a", b"a\x00"]
    hashes, owner, grams = kn_words._trigrams(held, np.cumsum([len(x) for x in held]), b"k")
    want = [(i, w) for i, x in enumerate(held) for w in [(b"", b"", *x.split())[k:k + 3] for k in range(len(x.split()))]]
    assert owner.tolist() == [i for i, _ in want]
    number = {}
    for got, (_, words) in zip(zip(*(hashes[x].tolist() for x in grams)), want, strict=True):
        assert all(number.setdefault(w, n) == n for w, n in zip(words, got))
    assert len(set(number.values())) == len(number)


def test_base_table(spark):
    """Base counts of whole batches against those of single texts."""
    r = random.Random(16)
    held = TEXTS + ["a b c a b c", "a b c d a b c", "#* #*\n#* #*\n", "\x0b\x0ca\n a\n a", "\x1cq\x85 \u00e9", "z" * 70 + " y x " + "z" * 70 + " y x"]
    held += ["".join(r.choice("ab #\n\t\u00e9") for _ in range(r.randrange(60))) for _ in range(300)]
    rows = spark.createDataFrame(list(enumerate(held)), "uid long, text string").coalesce(1)
    assert [tuple(x) for x in kn_words.base_table(rows).orderBy("uid").collect()] == [(i, *kn_quality.base_counts(t)) for i, t in enumerate(held)]


def test_word_buckets_do_not_follow_all_words(spark, monkeypatch):
    """A document's sums are as many at five times the words, and parts of a bucket give the bucket's sums."""
    assert kn_words.bucket_count(15_000_000) == kn_words.bucket_count(75_000_000) == 24
    assert kn_words.bucket_count(10**9) * kn_words.BUCKET_WORDS < 1.1 * 10**9
    r = random.Random(17)
    prose = [" ".join(f"w{int(40 * r.random() ** 2)}" for _ in range(60)) for _ in range(40)]
    rows = spark.createDataFrame(list(enumerate(prose)), "uid long, text string").selectExpr("*", "'en' AS lang").coalesce(1)
    table = kn_words._blocks(rows, 1, 1, 0, True).toArrow()
    table = table.append_column("known", pa.array([list(range(90, 62, -1))] * table.num_rows))
    c = kn_words.count_words(rows, 1).toArrow().column("c").unique()
    words = pa.table({"c": c, "w0": pa.array(range(1, len(c) + 1)), "w1": pa.array(range(len(c), 0, -1))})
    whole = kn_words._scores(table, words).to_pydict()
    counts = kn_words._blocks(rows, 1, 1, 0, False).toArrow()
    continued = kn_words._continued(counts).sort_by("c").to_pydict()
    monkeypatch.setattr(kn_words, "PART_BYTES", 2000)
    assert len(list(kn_words._opened(table)[1])) > 3
    assert kn_words._continued(counts).sort_by("c").to_pydict() == continued
    parts = kn_words._scores(table, words).to_pydict()
    assert parts["uid"] == whole["uid"] and np.allclose(parts["bits"], whole["bits"], rtol=1e-12) and len(whole["uid"]) == 40


def test_classifiers_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    docs = docs.union(spark.createDataFrame([(None, None, None, None, None), (10**6, "", "en", "s", 0)], docs.schema))
    for module, column, least in ((pu_quality, "quality", 0.95), (toxicity, "toxic", 0.93)):
        got = module.classify(docs, labels)
        assert got.count() == docs.count()
        assert got.where("score IS NULL OR score < 0 OR score > 1 OR held_out IS NULL").count() == 0
        known = got.where("held_out").join(labels, "doc_id").select("predicted", column).collect()
        assert all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in got.where("held_out").collect())
        assert np.mean([r.predicted == r[column] for r in known]) >= least
        none = module.classify(docs.limit(20), labels.limit(0))
        assert none.count() == 20 and none.select("score").distinct().count() == 1
        assert module.classify(docs.limit(0), labels).count() == 0


def test_prior_estimate_and_nonnegative_risk():
    rng = np.random.default_rng(0)
    good = lambda n: rng.normal([2, 0], 1, (n, 2))
    bad = lambda n: rng.normal([-3, 1], 1, (n, 2))
    model = pu_quality.fit(good(3000), np.vstack([good(2100), bad(900)]))
    assert abs(model.prior - 0.7) < 0.08
    assert (model.score(good(500)) > 0.5).mean() > 0.95 and (model.score(bad(500)) < 0.5).mean() > 0.95


def test_quality_model_of_least_risk_over_every_unlabelled_row(spark):
    """The weights against the risk by a plain loop over all rows, for the rows as an array and
    as a DataFrame of many partitions, and where the non-negative term ends the descent."""
    rng = np.random.default_rng(3)
    k = len(pu_quality.FEATURES)
    shift = np.linspace(-0.4, 0.4, k)
    positive = rng.normal(shift, 1, (300, k))
    rows = np.vstack([rng.normal(shift, 1, (420, k)), rng.normal(-shift, 1, (180, k))]).astype(np.float32).astype(float)
    frame = spark.createDataFrame([(x.tolist(),) for x in rows], "x array<float>").repartition(7)
    one, other = pu_quality.fit(positive, rows, 0.3), pu_quality.fit(positive, frame, 0.3)
    edge = pu_quality.fit(positive, rows, 0.7)  # here the second term ends the descent, and is not below zero
    p, u = edge.inputs(positive) @ edge.weights, edge.inputs(rows) @ edge.weights
    assert 0 <= np.logaddexp(0, u).mean() - 0.7 * np.logaddexp(0, p).mean() < 0.01
    assert np.allclose(one.weights, other.weights, atol=1e-6) and one.prior == other.prior

    def risk(w):
        good = bad = over = 0.0
        for z in one.inputs(positive):
            good += np.log1p(np.exp(-z @ w)) / len(positive)
            over += np.log1p(np.exp(z @ w)) / len(positive)
        for z in one.inputs(rows):
            bad += np.log1p(np.exp(z @ w)) / len(rows)
        return one.prior * good + max(0.0, bad - one.prior * over) + 0.5 * pu_quality.RIDGE / len(positive) * w @ w

    least = risk(one.weights)
    for _ in range(20):
        near = one.weights + rng.normal(0, 0.05, len(one.weights))
        if np.mean(np.logaddexp(0, one.inputs(rows) @ near)) >= one.prior * np.mean(np.logaddexp(0, one.inputs(positive) @ near)):
            assert risk(near) > least - 1e-6
    # every row twice is the same risk
    more = pu_quality.fit(positive, frame.unionByName(frame), 0.3)
    assert np.allclose(more.mean, rows.mean(axis=0)) and np.allclose(more.weights, one.weights, atol=1e-3)
    assert pu_quality.fit(positive, frame.limit(0)) is None


def test_quality_of_odd_rows(spark):
    docs = spark.createDataFrame([(1, "Good words, and more of them.", "x"), (1, "Good words, and more of them.", "y"), (2, None, "z"),
                                  (None, "", "z"), (3, "word " * 400_000, "z"), (4, "b|b|b !! B", "z")], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(1, 1), (3, 1), (4, 0), (2, None), (None, 1)], "doc_id long, quality int")
    got = pu_quality.classify(docs, labels).collect()
    assert len(got) == 6 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    assert len({r.score for r in got if r.doc_id == 1}) == 1


def test_fold(spark):
    from pyspark.sql import functions as F

    got = spark.createDataFrame([(1,), (2,), (None,), (-7,)], "d long").select("d", held_out(F.col("d")).alias("h")).collect()
    assert all(r.h == (r.d is not None and zlib.crc32(str(r.d).encode()) % 5 == 0) for r in got)
