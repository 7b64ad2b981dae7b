"""All elements of a page, cut in one pass, against a stack written in Python."""

import random
import time

import pytest
from pyspark.sql import functions as F

from quire.functions import markup as M

BREAKS_P = ["p", "div", "ul", "li", "h1", "table"]


def brute(tokens, tag):
    """Inner text of every `tag` element of a token list, by the rules of quire.functions.markup."""
    bearing = {"p": BREAKS_P, "li": ["li", "ul", "ol"]}.get(tag, [tag])
    out = []
    for i, (kind, name) in enumerate(tokens):
        if kind != "open" or name != tag:
            continue
        depth, inner = 1, []
        for kind2, name2 in tokens[i + 1:]:
            if kind2 == "text":
                inner.append(name2)
                continue
            if name2 not in bearing:
                inner.append(f"</{name2}>" if kind2 == "close" else f"<{name2}>")
                continue
            if tag == "p":
                depth = 0
            elif tag == "li" and name2 == "li":
                depth = 0 if depth == 1 else depth
            else:
                depth += 1 if kind2 == "open" else -1
            if depth == 0:
                break
        out.append("".join(inner))
    return out


def page_of(tokens):
    return "".join(t if k == "text" else f"</{t}>" if k == "close" else f"<{t}>" for k, t in tokens)


@pytest.mark.parametrize("tag", ["div", "li", "p", "span"])
def test_all_elements_equal_a_stack(spark, tag):
    rng = random.Random(tag)
    pages = []
    for _ in range(150):
        n = rng.choice([0, 1, 3, 10, 60])
        pages.append([("text", f"t{i}") if rng.random() < 0.4 else (rng.choice(["open", "close"]), rng.choice(["div", "ul", "li", "p", "span", "b"]))
                      for i in range(n)])
    df = spark.createDataFrame([(i, page_of(p)) for i, p in enumerate(pages)] + [(-1, None)], "i int, html string")
    got = {r.i: r.found for r in df.select("i", M.all_elements(M.visible("html"), tag).alias("found")).collect()}
    assert got.pop(-1) in (None, [])
    assert got == {i: brute(p, tag) for i, p in enumerate(pages)}


def test_running_depths_of_every_length(spark):
    rng = random.Random(7)
    rows = [([rng.choice([-1, 0, 1]) for _ in range(n)],) for n in (0, 1, 2, 3, 4, 5, 9, 10, 17, 100, 1001)]
    got = spark.createDataFrame(rows, "s array<int>").select("s", M._depths(F.col("s")).alias("d")).collect()
    for r in got:
        assert r.d == [sum(r.s[:i + 1]) for i in range(len(r.s))]


def test_work_grows_with_the_tags(spark):
    """Sixteen times the list items take far less than 16 x 16 times as long."""
    def seconds(n):
        df = spark.createDataFrame([("<ul>" + "<li class='a'>x</li>" * n + "</ul>",)], "html string")
        query = df.select(F.size(M.all_elements(M.visible("html"), "li", "a")).alias("n"))
        start = time.monotonic()
        assert query.first().n == n
        return time.monotonic() - start

    seconds(2000)
    small = max(seconds(2000), 0.05)
    assert seconds(32_000) < 60 * small


def test_named_references_all_and_unknown(spark):
    from html.entities import html5

    names = sorted(n for n in html5 if n.endswith(";"))
    df = spark.createDataFrame([("&" + n,) for n in names] + [("&nosuch;",), ("&amp",), ("&Amp;",)], "t string")
    got = {r.t: r.u for r in df.select("t", M.unescape("t").alias("u")).collect()}
    assert {n: got["&" + n] for n in names} == {n: html5[n] for n in names}
    assert (got["&nosuch;"], got["&amp"], got["&Amp;"]) == ("&nosuch;", "&amp", "&Amp;")


def test_one_cut_for_several_elements(spark):
    """`first_elements` gives what `first_element` and `open_tags` give, also where a quoted attribute
    holds tags, tags are left open or the page is null; a page without such attributes is cut once (F1)."""
    bits = ['<div class="bc-info">', "<div>", "</div>", '<h1 class="t u">', "</h1>", "<H2 class=v>", "</h2>", '<a class="l" href="/a">',
            "</a>", '<a href=x title="<div class=bc-info>">', " x ", "é&amp;", '<table class="a b">', "</table>", "<p>", "</div ", "<div",
            "<", ">", '"', "<h10>", "<br/>", "<div/>", '</table x="<h1>">']
    r = random.Random(5)
    pages = ["".join(r.choice(bits) for _ in range(r.randrange(25))) for _ in range(600)] + [None, ""]
    chosen = [("h1", "u"), ("h2", "v"), ("div", "bc-info"), ("table", "b"), ("div", None)]
    page = F.col("p")
    got = spark.createDataFrame([(p,) for p in pages], "p string").repartition(4).select(
        M.first_elements(page, chosen, "a").alias("once"), F.array(*[M.first_element(page, *s) for s in chosen]).alias("each"),
        M.open_tags(page, "a").alias("opened"), F.exists(M._cut(page, "h1|h2|div|table|a")["tags"], lambda t: F.locate("<", t, 2) > 0).alias("nested")).collect()
    assert all(x.once.elements == x.each and x.once.opened == x.opened for x in got)
    for nested in (True, False):
        assert sum(bool(x.nested) == nested and any(e is not None for e in x.each) for x in got) > 50
    with pytest.raises(ValueError):
        M.first_elements(page, [("li", None)], "a")
