"""URL rules, WARC transactions and decontamination against brute force."""

import base64
import gzip
import hashlib
import io
import random
import re

import numpy as np
import pytest

from quire.llm import decontaminate, registry, url_rules, warc
from quire.llm.common import shared_folder
from quire.llm.url_rules import Rule

URLS = [None, "", "no scheme", "http://", "http://EXAMPLE.org", "http://example.org/es/1", "http://a.b.example.org/en/12?x=1",
        "https://notexample.org/es/", "http://x.com/fr/", "http://x.com/FR/", "ftp://x.com/de/q#f", "http://x.net/cart/1",
        "http://x.net/a.exe", "http://u:p@example.org:80/es/", "a://b://c/d", "http://com/fr/x", "http://x.com?/de/", "http://É.org/ü/"]


def brute_verdict(url, rules, globs):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (m[1], m[2]) if m else ("", "")
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = []
    for r in rules:
        h, _, p = r.pattern.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
            fits.append((1, len(r.pattern), r.pattern, r.verdict))
    for r in globs:
        if re.search("(?s)" + ".*".join(map(re.escape, r.pattern.split("*"))), host + path):
            fits.append((0, len(r.pattern), r.pattern, r.verdict))
    top = max(fits, default=(0, 0, None, "allow"))
    return host, path, top[2] if top[0] else None, top[3]


@pytest.mark.parametrize("max_inline", [100, 0])
def test_url_rules(spark, max_inline):
    rows = [(i, u, "h") for i, u in enumerate(URLS)] + [(None, URLS[5], "h"), (5, URLS[5], "h")]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string")
    got = url_rules.judge_urls(pages, registry.URL_RULES, ["page_id"], max_inline=max_inline).collect()
    want = [(i, *brute_verdict(u, registry.URL_RULES, url_rules.DEFAULT_GLOBS)) for i, u, _ in rows]
    key = lambda x: tuple(map(str, x))
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    assert url_rules.judge_urls(pages.limit(0), registry.URL_RULES, ["page_id"], max_inline=max_inline).count() == 0
    assert {r.verdict for r in url_rules.judge_urls(pages, [], ["page_id"], globs=[]).collect()} == {"allow"}


def test_rules_are_filed_under_their_rarest_token(spark):
    seen = spark.createDataFrame([("a.org/x",)] * 3 + [("b.org/y",)], "address string")
    rules = [Rule("block", "a.org/"), Rule("block", "b.org/y/"), Rule("block", "*x*", True), Rule("allow", "org/en/1")]
    assert [t for t, _ in url_rules.rule_index(seen, rules)] == ["a", "b", "", "en"]


def test_url_query_runs_no_python(spark):
    plan = registry.QUERIES["op2_url_filters"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)


@pytest.mark.parametrize("min_bytes", [0, 4])
def test_warc_round_trip(spark, min_bytes):
    rows = [(3, "http://a/x", "same", 1), (1, "http://a/y", "same", 1), (2, None, "same", 1), (4, "u", None, 1), (9, "u", "", 1),
            (5, "http://é/\r\nx", "é" * 10, 1), (None, "n", "é" * 10, 1), (7, "w", "dup", 1), (7, "w", "dup", 1), (8, "w", "dup", 1), (6, "z", "z" * 70000, 1)]
    got = warc.page_captures(spark.createDataFrame(rows, "page_id long, url string, html string, digest int"), min_bytes).collect()
    assert len(got) == len(rows)
    groups = {}
    for p, _, h, _ in rows:
        groups.setdefault(h or "", []).append(p)
    want = []
    for h, pages in groups.items():
        data = h.encode()
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        pages = sorted(pages, key=lambda p: (p is None, p or 0))
        for i, p in enumerate(pages):
            again = i > 0 and len(data) >= min_bytes
            want.append((p, len(data), digest, "revisit" if again else "response", pages[0] if again else None))
    key = lambda x: tuple(map(str, x))
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.page_captures(empty).count() == 0


def test_archives_are_valid_and_transactions_nest(spark):
    pages = spark.createDataFrame([(1, "http://a/x", "hello"), (2, "http://a/y", "hello")], "page_id long, url string, html string")
    manifest = warc.write_archives(pages, shared_folder(spark, "t"))
    records = warc.read_records(spark, manifest, payloads=True)
    kinds = sorted(r.type for r in records.collect())
    assert kinds.count("warcinfo") >= 1 and [k for k in kinds if k != "warcinfo"] == ["metadata", "metadata", "request", "request", "response", "revisit"]
    nested = {r.type: r for r in warc.assemble(records).collect()}
    assert nested["response"].payload == b"hello" and nested["revisit"].payload is None
    assert nested["revisit"].refers_to == nested["response"].record_id
    for r in nested.values():
        assert len(r.requests) == len(r.metadata) == 1 and r.metadata[0].fields["page-id"] in "12"
    # the other direction, and metadata of a request
    rows = [("c1", "response", "q1"), ("q1", "request", None), ("m1", "metadata", "q1"), ("c2", "response", None), ("m2", "metadata", "gone")]
    made = spark.createDataFrame([(i, t, c, None, None, None, 0, None, {}) for i, t, c in rows],
                                 "record_id string, type string, concurrent_to string, refers_to string, target_uri string, date string, "
                                 "payload_bytes long, payload_digest string, fields map<string,string>")
    got = {r.record_id: ([x.record_id for x in r.requests or []], [x.record_id for x in r.metadata or []]) for r in warc.assemble(made).collect()}
    assert got == {"c1": (["q1"], ["m1"]), "c2": ([], [])}
    stream = io.BytesIO(gzip.decompress(warc.record([("WARC-Type", "x"), ("Bad", "a\r\nb")], b"body")))
    assert [(h["bad"], b) for h, b in warc.parse_records(stream)] == [("a%0D%0Ab", b"body")]


def edit_distance(a, b):
    """Least edits of a to a part of b."""
    row = [0] * (len(b) + 1)
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def test_fitting_distance():
    r = random.Random(3)
    for _ in range(200):
        a = np.array([r.randrange(4) for _ in range(r.randint(1, 12))])
        b = np.array([r.randrange(4) for _ in range(r.randint(0, 20))], np.int64)
        d, x, y = decontaminate.fitting_distance(a, b)
        assert d == edit_distance(a.tolist(), b.tolist())
        assert 0 <= x <= y <= len(b)


@pytest.mark.parametrize("block_items", [1000, 7])
def test_decontamination(spark, block_items):
    r = random.Random(8)
    words = ["".join(r.choice("abcdefgh") for _ in range(r.randint(2, 6))) for _ in range(400)]
    say = lambda n: [r.choice(words) for _ in range(n)]
    items = [(i, " ".join(say(r.randint(8, 60))).capitalize() + ".") for i in range(30)] + [(100, None), (101, " ?!"), (102, items_text := "One single item here")]
    docs, planted = [(-1, None), (-2, ""), (-3, items_text.upper())], {(-3, 102)}
    for k in range(150):
        body = say(r.randint(0, 200))
        if k % 2:
            i, t = items[r.randrange(30)]
            w = t.split()
            for _ in range(r.randint(0, int(0.12 * len(w)))):
                w[r.randrange(len(w))] = "zzz"
            at = r.randint(0, len(body))
            body[at:at] = w
            planted.add((k, i))
        docs.append((k, " ".join(body)))
    docs += [(3, dict(docs)[3])]
    rows = decontaminate.contaminated(spark.createDataFrame([(*d, "e") for d in docs], "doc_id long, text string, edits string"),
                                      spark.createDataFrame(items, "item_id long, text string"), block_items=block_items).collect()
    found = {(x.doc_id, x.item_id) for x in rows}
    text, item = dict(docs), dict(items)
    norm = lambda t: re.findall(r"\w+", (t or "").lower())
    for x in rows:
        a, b = norm(item[x.item_id]), norm(text[x.doc_id])
        assert x.edits == edit_distance(a, b[x.first_word:x.end_word]) <= 0.2 * len(a)
    brute = {(d, i) for d, t in docs for i, s in items if norm(s) and edit_distance(norm(s), norm(t)) <= 0.2 * len(norm(s)) + 1e-9}
    assert found <= brute and planted <= brute
    assert len(found & planted) >= 0.97 * len(planted) and len(found) >= 0.9 * len(brute)
    assert sum(x.doc_id == 3 for x in rows) == 2 * len({i for d, i in found if d == 3})
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), none).count() == 0


@pytest.mark.parametrize("size", [300, 500, 1000])
def test_edited_copies_of_long_items_are_found(size):
    r = random.Random(size)
    found, trials = 0, 50
    items = [[f"w{r.randrange(3000)}" for _ in range(size)] for _ in range(5)]
    block = decontaminate.build_block([(i, " ".join(x)) for i, x in enumerate(items)])
    number = lambda words: np.array([block.vocabulary.get(w, -1) for w in words], np.int64)
    for n in range(trials):
        w = list(items[n % 5])
        for _ in range(decontaminate.edits(size, decontaminate.SIMILARITY)):
            k, kind = r.randrange(len(w)), r.randrange(3)
            w[k:k + (kind > 0)] = ["zzz"] if kind < 2 else []
        other = ["yyy"] * r.randrange(30)
        got = decontaminate.matches([number(["yyy"] * 5), number(other + w + other)], block)
        found += any((k, i) == (1, n % 5) for k, i, *_ in got)
    assert found >= 0.98 * trials


def test_few_keys_are_looked_up(monkeypatch):
    """Keys whose leading bits no item's key has are dropped before the search, and none that an item has."""
    r = random.Random(8)
    items = [[f"w{r.randrange(400)}" for _ in range(20)] for _ in range(30)]
    block = decontaminate.build_block([(i, " ".join(x)) for i, x in enumerate(items)])
    texts = [[f"w{r.randrange(400)}" for _ in range(300)] for _ in range(40)]
    texts[3][100:120] = items[7]
    made, asked, keys, search = [0], [0], decontaminate.keys, np.searchsorted

    def counted(*x):
        out = keys(*x)
        made[0] += out.size
        return out

    def searched(table, values, *x, **y):
        asked[0] += np.size(values) * (table.dtype == np.uint64)
        return search(table, values, *x, **y)

    monkeypatch.setattr(decontaminate, "keys", counted)
    monkeypatch.setattr(np, "searchsorted", searched)
    got = decontaminate.matches([np.array([block.vocabulary.get(w, -1) for w in t], np.int64) for t in texts], block)
    assert (3, 7, 0, 100, 120) in got and made[0] > 50_000 and asked[0] < made[0] / 4


def test_walks_never_fall_short_silently(monkeypatch):
    monkeypatch.setattr(decontaminate, "MAX_WALKS", 4)
    with pytest.raises(ValueError):
        decontaminate.walks_for([np.arange(1000)], 1999, 1000, 0.8, 0.98)
