"""Element text for markup the regex selectors cannot cut: an element that
contains elements of its own tag name (a <div> inside the selected <div>).

A small per-row helper: the stdlib HTML parser walks each page in an
Arrow-batched pandas UDF, so Spark still partitions and schedules the work;
the regex selectors in `quire.plans.pages` remain the fast default.
"""

from __future__ import annotations

import re
import sys
from html.parser import HTMLParser

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

# Ship this module's code with the UDF (stdlib + pandas only), so executors
# need no installed copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# --- fixed values: HTML elements that never have an end tag ----------------
VOID_TAGS = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source",
             "track", "wbr"}
# ---------------------------------------------------------------------------


class _FirstElement:
    """Collects the text of the first element matching tag / class / attribute,
    counting nested elements of the same name."""

    def __init__(self, tag: str, cls: str | None, attr: tuple[str, str] | None):
        self.tag, self.cls, self.attr = tag, cls, attr
        self.depth = 0
        self.found = False
        self.done = False
        self.parts: list[str] = []

    def _matches(self, attrs) -> bool:
        a = dict(attrs)
        if self.cls is not None and self.cls not in (a.get("class") or "").split():
            return False
        return self.attr is None or a.get(self.attr[0]) == self.attr[1]

    def start(self, attrs) -> None:
        """An opening tag of the element's name."""
        if self.done:
            return
        if self.depth:
            if self.tag not in VOID_TAGS:
                self.depth += 1
        elif self._matches(attrs):
            self.found = True
            if self.tag in VOID_TAGS:
                self.done = True
            else:
                self.depth = 1

    def end(self) -> None:
        if self.depth:
            self.depth -= 1
            if self.depth == 0:
                self.done = True

    def text(self, space_to: str) -> str | None:
        if not self.found:
            return None
        text = re.sub(r"\n+", "\n", "".join(self.parts))
        return re.sub(r" +", space_to, text).strip()


class _FirstElements(HTMLParser):
    """Walks a page once for all `wanted` elements."""

    def __init__(self, wanted: list[_FirstElement]):
        super().__init__(convert_charrefs=True)
        self.wanted = wanted
        self.by_tag: dict[str, list[_FirstElement]] = {}
        for e in wanted:
            self.by_tag.setdefault(e.tag, []).append(e)

    def handle_starttag(self, tag, attrs):
        for e in self.by_tag.get(tag, ()):
            e.start(attrs)

    def handle_endtag(self, tag):
        for e in self.by_tag.get(tag, ()):
            e.end()

    def handle_data(self, data):
        for e in self.wanted:
            if e.depth:
                e.parts.append(data)


def first_element_texts(html: str | None, selectors: list[tuple]) -> list[str | None]:
    """For each (tag, class, attribute, space_to): text of the first matching
    element with newline / space runs squeezed and the ends stripped; None when
    no element matches. The page is parsed once."""
    if html is None:
        return [None] * len(selectors)
    wanted = [_FirstElement(tag, cls, attr) for tag, cls, attr, _ in selectors]
    p = _FirstElements(wanted)
    p.feed(html)
    p.close()
    return [e.text(space_to) for e, (*_, space_to) in zip(wanted, selectors)]


def first_element_text(html: str | None, tag: str, cls: str | None = None,
                       attr: tuple[str, str] | None = None, space_to: str = " ") -> str | None:
    """`first_element_texts` of one element."""
    return first_element_texts(html, [(tag, cls, attr, space_to)])[0]


def element_texts_parsed(html: Column, selectors: list[tuple]) -> Column:
    """Column version of `first_element_texts` (Arrow batches of pages): an array in the order of `selectors`."""

    @pandas_udf("array<string>")
    def parse(pages: pd.Series) -> pd.Series:
        return pages.map(lambda h: first_element_texts(h, selectors))

    return parse(html)


def element_text_parsed(html: Column, tag: str, cls: str | None = None,
                        attr: tuple[str, str] | None = None, space_to: str = " ") -> Column:
    """Column version of `first_element_text`."""
    return F.get(element_texts_parsed(html, [(tag, cls, attr, space_to)]), F.lit(0))
