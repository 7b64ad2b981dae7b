"""Elements, attributes and character references of HTML text, as native column expressions.

A page is read as a list of tags of one name and the text pieces between them.
An element starts at the first tag that matches and ends where its nesting
depth is back at zero; an element that is never closed runs to the page's end.
A paragraph (`p`) holds no blocks, so any block tag ends it; a list item (`li`)
is ended by the next item of its list or by the list's end.

Tag and attribute names match in any case. An attribute value may be double
quoted, single quoted or bare, with blanks around its `=`. Comments, scripts
and style sheets hold no elements and no text. A class must be one whole token
of the class list. Null html gives null.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from quire.functions import cleaning as C

# --- fixed values: tags that end a paragraph, after the HTML standard --------
BLOCKS = ["address", "article", "aside", "blockquote", "body", "dd", "details", "div", "dl", "dt", "fieldset",
          "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "li",
          "main", "menu", "nav", "ol", "pre", "section", "table", "td", "th", "tr", "ul"]
# fixed values: what references to the C1 controls 0x80-0x9F stand for in HTML
C1_NUMBERS = "".join(map(chr, [0x80, *range(0x82, 0x8D), 0x8E, *range(0x91, 0x9D), 0x9E, 0x9F]))
C1_MEANT = "€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ"
# fixed values: references that pages use most
COMMON = ["amp", "lt", "gt", "quot", "apos", "nbsp", "laquo", "raquo", "mdash", "ndash", "hellip"]
# ---------------------------------------------------------------------------

# alternatives share their first "<", so that other places of a text are passed with one comparison
INVISIBLE = r"(?is)<(?:!--.*?(?:-->|\z)|(script|style)(?=[\s/>])[^>]*+>.*?(?:</\1\s*+>|\z))"
INSIDE_TAG = r"""(?:=\s*+"[^"]*+"|=\s*+'[^']*+'|[^>=]++|=)*+"""  # a quote may hold '>'
ATTRIBUTE = r"""[^\s"'<>/=]+(?:\s*=\s*(?:"[^"]*"|'[^']*'|[^\s"'>][^\s>]*))?"""
DEC_REF = r"^#0*([0-9]+);"
HEX_REF = r"^#[xX]0*([0-9a-fA-F]+);"
NAMED_REF = r"^([A-Za-z][A-Za-z0-9]*);"
_ENTRY, _MEANS = "\x01", "\x02"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is evaluated once, however often it is used."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def visible(html) -> Column:
    """The page without comments, scripts and style sheets."""
    return F.regexp_replace(C.as_col(html), INVISIBLE, "")


# --- character references ----------------------------------------------------

def _code_point(number: Column) -> Column:
    """The character of a code point, decoded natively (UTF-32). Zero, surrogates
    and numbers beyond Unicode (or too long to be one: null) are U+FFFD."""
    good = F.when(number.between(1, 0xD7FF) | number.between(0xE000, 0x10FFFF), number)
    char = F.decode(F.unhex(F.lpad(F.hex(F.coalesce(good, F.lit(0xFFFD))), 8, "0")), "UTF-32")
    return F.translate(char, C1_NUMBERS, C1_MEANT)


def _number(digits: Column, base: int) -> Column:
    """Value of up to 8 digits; null for more."""
    return F.when(F.length(digits) <= 8, F.conv(digits, base, 10).try_cast("long"))


def _reference_table() -> str:
    """Every named reference of HTML and its characters as one text: a literal of this
    size costs a plan little, where a map of as many entries is compared entry by entry."""
    return _ENTRY + _ENTRY.join(n[:-1] + _MEANS + html5[n] for n in sorted(html5) if n.endswith(";")) + _ENTRY


def _named(name: Column) -> Column:
    """The characters of a named reference; null for an unknown name. The common ones are
    told apart before the table is searched."""
    table = F.lit(_reference_table())

    def found(at: Column) -> Column:
        start = at + F.char_length(name) + 2
        return F.when(at > 0, F.substring_index(table.substr(start, F.lit(8)), _ENTRY, 1))

    out = let(F.position(F.concat(F.lit(_ENTRY), name, F.lit(_MEANS)), table), found)
    for common in reversed(COMMON):
        out = F.when(name == common, html5[common + ";"]).otherwise(out)
    return out


def unescape(c) -> Column:
    """Decode numeric (&#1085; &#x43D;) and named (&eacute;) references, each
    once: '&amp;#39;' becomes '&#39;'. Unknown names, and names without their
    semicolon, stay as they are; texts without '&' pass through."""
    def decode(t: Column) -> Column:
        dec, hx = F.regexp_extract(t, DEC_REF, 1), F.regexp_extract(t, HEX_REF, 1)
        name = let(F.regexp_extract(t, NAMED_REF, 1), _named)
        after = F.regexp_replace(t, r"^[^;]*+;", "")
        return (F.when(dec != "", F.concat(_code_point(_number(dec, 10)), after))
                .when(hx != "", F.concat(_code_point(_number(hx, 16)), after))
                .when(t.rlike(NAMED_REF), F.coalesce(F.concat(name, after), F.concat(F.lit("&"), t)))
                .otherwise(F.concat(F.lit("&"), t)))

    def whole(s: Column) -> Column:
        tail = let(F.split(s, "&"), lambda parts: F.concat(
            F.get(parts, F.lit(0)), F.array_join(F.transform(F.slice(parts, 2, F.size(parts)), decode), "")))
        return F.when(s.contains("&"), tail).otherwise(s)

    return let(C.as_col(c), whole)


def strip_tags(c) -> Column:
    return F.regexp_replace(C.as_col(c), rf"<(?:/?[A-Za-z]{INSIDE_TAG}>|[!?][^>]*+>)", "")


# --- tags ----------------------------------------------------------------------

def open_tags(page: Column, tag: str) -> Column:
    """Every opening tag of that name, as written."""
    return F.regexp_extract_all(page, F.lit(rf"(?i)<{tag}(?=[\s/>]){INSIDE_TAG}>"), F.lit(0))


def raw_attribute(tag_text: Column, name: str) -> Column:
    """Value of an attribute of one tag, as written; '' without a value, null when absent."""
    items = F.regexp_extract_all(tag_text, F.lit(ATTRIBUTE), F.lit(0))
    own = F.filter(items, lambda x, i: (i > 0) & x.rlike(rf"(?is)^{name}\s*(=|\z)"))  # item 0: the tag's name
    value = F.regexp_replace(F.get(own, F.lit(0)), r"(?s)^[^=]*+(=\s*+)?", "")
    return F.regexp_replace(value, r"""(?s)^(["'])(.*)\1\z""", "$2")


def attribute_of(tag_text: Column, name: str) -> Column:
    """Value of an attribute of one tag, references decoded; null when absent."""
    return let(raw_attribute(tag_text, name), unescape)


def has_class(tag_text: Column, cls: str) -> Column:
    listed = F.coalesce(raw_attribute(tag_text, "class"), F.lit("")).rlike(rf"(?:\A|\s){re.escape(cls)}(?:\s|\z)")
    return tag_text.contains(cls) & listed


def _is(tag_text: Column, tag: str, cls: str | None, attr: tuple[str, str] | None) -> Column:
    same = tag_text.rlike(rf"(?i)^<{tag}[\s/>]")
    if cls is not None:
        same = has_class(tag_text, cls) & same
    if attr is not None:
        same = same & F.coalesce(attribute_of(tag_text, attr[0]) == attr[1], F.lit(False))
    return same


# --- elements ------------------------------------------------------------------

def _depth(tag: str, depth: Column, t: Column) -> Column:
    """Nesting depth after the tag `t`; the element ends at 0."""
    if tag == "p":
        return F.lit(0)
    step = F.when(t.startswith("</"), depth - 1).otherwise(depth + 1)
    if tag == "li":
        item = t.rlike(r"(?i)^</?li[\s/>]")
        return F.when(item & (depth == 1), 0).when(item, depth).otherwise(step)
    return step


def _cut(page: Column, tag: str) -> Column:
    """(tags, pieces): the tags that bear on where `tag` elements begin and end,
    and the text between them (one piece more)."""
    names = {"p": "|".join(["p", *BLOCKS]), "li": "li|ul|ol"}.get(tag, tag)
    bounds = rf"(?i)<(?:(?:{names})(?=[\s/>]){INSIDE_TAG}>|/(?:{names})(?=[\s/>])[^>]*+>)"
    return F.struct(F.regexp_extract_all(page, F.lit(bounds), F.lit(0)).alias("tags"),
                    F.split(page, bounds, -1).alias("pieces"))


def _inner(cut: Column, place: Column, tag: str, mixed: bool = False) -> Column:
    """Inner html of the element whose tag is the `place`-th (from 1), without
    the tags that `_cut` cut at. In a `mixed` cut there are tags of other names too; these stay."""
    tags, pieces = cut["tags"], cut["pieces"]
    begin = F.struct(F.lit(1).alias("depth"), F.lit(0).alias("taken"))

    def own(t: Column) -> Column:
        return t.rlike(rf"(?i)^</?{tag}[\s/>]")

    def depth(s: Column, t: Column) -> Column:
        after = _depth(tag, s["depth"], t)
        return F.when(own(t), after).otherwise(s["depth"]) if mixed else after

    end = F.aggregate(
        F.slice(tags, place + 1, F.size(tags)), begin,
        lambda s, t: F.when(s["depth"] == 0, s).otherwise(
            F.struct(depth(s, t).alias("depth"), (s["taken"] + 1).alias("taken"))))
    count = let(end, lambda s: s["taken"] + F.when(s["depth"] > 0, 1).otherwise(0))
    if not mixed:
        return F.array_join(F.slice(pieces, place + 1, count), "")

    def text(n: Column) -> Column:
        inside = F.transform(F.slice(tags, place + 1, n - 1), lambda t: F.when(own(t), "").otherwise(t))
        return F.array_join(F.transform(F.slice(pieces, place + 1, n), lambda x, i: F.concat(x, F.coalesce(F.get(inside, i), F.lit("")))), "")

    return let(count, text)


def _first(cut: Column, tag: str, cls: str | None = None, attr: tuple[str, str] | None = None, mixed: bool = False) -> Column:
    places = F.transform(cut["tags"], lambda t, i: F.when(_is(t, tag, cls, attr), i + 1))
    place = F.get(F.filter(places, lambda i: i.isNotNull()), F.lit(0))
    return let(place, lambda i: F.when(i > 0, _inner(cut, i, tag, mixed)))


def first_element(page: Column, tag: str, cls: str | None = None, attr: tuple[str, str] | None = None) -> Column:
    """Inner html of the first matching element of a `visible` page; null when there is none."""
    return let(_cut(page, tag), lambda cut: _first(cut, tag, cls, attr))


def first_elements(page: Column, selectors: list[tuple], opened: str) -> Column:
    """A struct of `elements`, the `first_element` of each selector (tag, class, attribute), and `opened`, the
    `open_tags` of that name. The page is cut once, at the tags of all names; where one of them
    holds a further '<' (in an attribute), the tags of one name may lie in those of another, and each
    selector cuts the page itself. Not for `p` and `li`, which other tags end."""
    names = dict.fromkeys([*(s[0] for s in selectors), opened])
    if names.keys() & {"p", "li"}:
        raise ValueError("p and li are cut at other tags too")

    def both(elements: list[Column], tags: Column) -> Column:
        return F.struct(F.array(*elements).alias("elements"), tags.alias("opened"))

    def found(cut: Column) -> Column:
        nested = F.exists(cut["tags"], lambda t: F.locate("<", t, 2) > 0)
        return F.when(nested, both([first_element(page, *s) for s in selectors], open_tags(page, opened))).otherwise(
            both([_first(cut, *s, mixed=True) for s in selectors],
                 F.filter(cut["tags"], lambda t: t.rlike(rf"(?i)^<{opened}[\s/>]"))))

    return let(_cut(page, "|".join(names)), found)


def _step(tag: str, t: Column) -> Column:
    """Change of the nesting depth at the tag `t`."""
    if tag == "p":
        return F.lit(0)
    step = F.when(t.startswith("</"), -1).otherwise(1)
    return F.when(t.rlike(r"(?i)^</?li[\s/>]"), 0).otherwise(step) if tag == "li" else step


def _level(tag: str, t: Column, depth: Column) -> Column:
    """The level at which the tag `t` begins or ends elements, by the depth behind it;
    null where it does neither. An element ends at the next tag of its level."""
    if tag == "p":
        return F.lit(0)
    if tag == "li":
        return F.when(t.rlike(r"(?i)^</?li[\s/>]"), depth).when(t.startswith("</"), depth + 1)
    return F.when(t.startswith("</"), depth + 1).otherwise(depth)


def _depths(steps: Column) -> Column:
    """Running sums of `steps`. A fold that appends copies what it has, so the sums are
    built in blocks of sqrt(n) steps, and the blocks' own sums in another fold."""
    def running(values: Column) -> Column:
        begin = F.struct(F.lit(0).alias("sum"), F.expr("CAST(array() AS array<int>)").alias("all"))
        return F.aggregate(values, begin, lambda s, x: F.struct(
            (s["sum"] + x).alias("sum"), F.concat(s["all"], F.array(s["sum"] + x)).alias("all")))["all"]

    def whole(size: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(steps) - 1, size)
        blocks = F.transform(starts, lambda i: running(F.slice(steps, i + 1, size)))

        def joined(parts: Column) -> Column:
            before = running(F.transform(parts, lambda b: F.element_at(b, -1)))
            return let(before, lambda sums: F.flatten(F.transform(
                parts, lambda b, k: F.transform(b, lambda x: x + F.when(k > 0, F.get(sums, k - 1)).otherwise(0)))))

        return let(blocks, joined)

    block = F.ceil(F.sqrt(F.size(steps))).cast("int")
    return F.when(F.size(steps) > 0, let(block, whole)).otherwise(steps)


def _ends(tags: Column, tag: str) -> Column:
    """For every tag that begins or ends an element, in order: its place and the place of the
    next tag of its level (both from 1; null if there is none). One sort by level and place
    finds all of them, however many elements a page has."""
    if tag == "p":
        count = F.size(tags)
        return F.transform(tags, lambda _, i: F.struct((i + 1).alias("place"), F.when(i + 1 < count, i + 2).alias("end")))
    steps = F.transform(tags, lambda t: _step(tag, t))

    def events(depths: Column) -> Column:
        marked = F.transform(tags, lambda t, i: F.struct(_level(tag, t, F.get(depths, i)).alias("level"), (i + 1).alias("place")))
        return F.array_sort(F.filter(marked, lambda e: e["level"].isNotNull()))

    def pairs(ordered: Column) -> Column:
        def pair(e: Column, i: Column) -> Column:
            after = F.get(ordered, i + 1)
            return F.struct(e["place"].alias("place"), F.when(after["level"] == e["level"], after["place"]).alias("end"))

        return F.array_sort(F.transform(ordered, pair))

    return let(let(let(steps, _depths), events), pairs)


def all_elements(page: Column, tag: str, cls: str | None = None) -> Column:
    """Inner html of every matching element of a `visible` page, nested ones too. The work
    grows with the page's tags (and the text given back), not with their square."""
    def found(cut: Column) -> Column:
        tags, pieces = cut["tags"], cut["pieces"]
        own = F.filter(_ends(tags, tag), lambda e: _is(F.element_at(tags, e["place"]), tag, cls, None))
        last = F.size(pieces)
        return F.transform(own, lambda e: F.array_join(F.slice(pieces, e["place"] + 1, F.coalesce(e["end"], last) - e["place"]), ""))

    return let(_cut(page, tag), found)
