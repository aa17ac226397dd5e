"""Elements of captured pages as rows.

Python does one thing here: it reads a page and hands back the elements that
some selectors match, with their text, links, cells and parts.  What they mean
is left to expressions on the rows.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_SELF_CLOSING = {"li": ("li",), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "p": ("p",), "option": ("option",)}
_SCOPE = {"li": ("ul", "ol"), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"), "p": ("div", "td", "li", "article", "body"), "option": ("select",)}

_ITEM = "struct<text:string,href:string,column:string,attrs:array<string>>"
ELEMENT = f"struct<kind:string,position:int,text:string,href:string,id:string,inner:string,lines:array<string>,links:array<{_ITEM}>,cells:array<{_ITEM}>,parts:map<string,array<{_ITEM}>>>"


_HIDDEN = ("script", "style")


class Element:
    """An element of a page; ``at`` and ``end`` are its place and that of the next one outside of it, ``first`` and ``last`` the same for its strings."""

    __slots__ = ("tag", "attrs", "children", "parent", "page", "at", "end", "first", "last")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Element | None) -> None:
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.children: list[Element | str] = []

    def walk(self) -> list[Element]:
        return self.page.nodes[self.at + 1 : self.end]

    def strings(self) -> list[str]:
        if self.tag in _HIDDEN:
            return [c for c in self.children if isinstance(c, str)]
        return self.page.strings[self.first : self.last]

    def inner(self) -> str:
        """Its text, and the values of all attributes inside, as a place to look for addresses."""
        return " ".join([*self.strings(), *(v for e in self.walk() for v in e.attrs.values())])

    def lines(self) -> list[str]:
        return [x for s in self.strings() if (x := " ".join(s.split()))]

    def text(self) -> str:
        return " ".join(" ".join(self.strings()).split())


class _Page:
    """All elements and strings of a page in its order, and where the elements of each tag, class and id are."""

    def __init__(self, root: Element) -> None:
        self.nodes: list[Element] = []
        self.strings: list[str] = []
        self.by: dict[str, list[int]] = {}
        left: list[Element | str | tuple[Element]] = [root]
        hidden = 0
        while left:
            x = left.pop()
            if isinstance(x, str):
                if not hidden:
                    self.strings.append(x)
            elif isinstance(x, tuple):
                x[0].end, x[0].last = len(self.nodes), len(self.strings)
                hidden -= x[0].tag in _HIDDEN
            else:
                x.page, x.at, x.first = self, len(self.nodes), len(self.strings)
                self.nodes.append(x)
                hidden += x.tag in _HIDDEN
                for key in (x.tag, *{f".{c}" for c in x.attrs.get("class", "").split()}, f"#{x.attrs.get('id', '')}"):
                    self.by.setdefault(key, []).append(x.at)
                left.append((x,))
                left += reversed(x.children)

    def inside(self, top: Element, key: str) -> list[Element]:
        """Elements inside ``top`` that have the tag, .class or #id; all of them without a key."""
        if not key:
            return top.walk()
        places = self.by.get(key, [])
        return [self.nodes[i] for i in places[bisect_right(places, top.at) : bisect_left(places, top.end)]]


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.at = Element("", {}, None)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        up = self.at
        while tag in _SELF_CLOSING and up.parent is not None and up.tag not in _SCOPE[tag]:
            if up.tag in _SELF_CLOSING[tag]:
                self.at = up.parent
                break
            up = up.parent
        element = Element(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.children.append(element)
        if tag not in _VOID:
            self.at = element

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.at.children.append(Element(tag, {k: v or "" for k, v in attrs}, self.at))

    def handle_endtag(self, tag: str) -> None:
        up = self.at
        while up.parent is not None:
            if up.tag == tag:
                self.at = up.parent
                return
            up = up.parent

    def handle_data(self, data: str) -> None:
        self.at.children.append(data)


def parse(page: str) -> Element:
    builder = _Builder()
    builder.feed(page)
    builder.close()
    _Page(builder.root)
    return builder.root


_SIMPLE = re.compile(r"""([a-zA-Z][\w-]*|\*)?((?:\.[\w-]+|\#[\w-]+|\[[^\]]+\])*)""")
_TEST = re.compile(r"""\.([\w-]+)|\#([\w-]+)|\[([\w-]+)(?:([\^$*]?=)["']?([^"'\]]*)["']?)?\]""")
_HOW = {"=": str.__eq__, "^=": str.startswith, "$=": str.endswith, "*=": str.__contains__}


class _Simple:
    """One step of a selector: a tag and what is asked of classes, id and attributes."""

    def __init__(self, simple: str) -> None:
        m = _SIMPLE.fullmatch(simple)
        if not m:
            raise ValueError(f"selector not understood: {simple}")
        self.tag = m[1].lower() if m[1] not in (None, "*") else ""
        found = _TEST.findall(m[2])
        self.classes, self.ids = [f[0] for f in found if f[0]], [f[1] for f in found if f[1]]
        self.attrs = [(f[2], _HOW.get(f[3]), f[4]) for f in found if f[2]]
        #: by which its elements are looked up
        self.key = f".{self.classes[0]}" if self.classes else f"#{self.ids[0]}" if self.ids else self.tag

    def fits(self, e: Element) -> bool:
        if self.tag and e.tag != self.tag:
            return False
        if self.classes and not set(self.classes) <= set(e.attrs.get("class", "").split()):
            return False
        if any(e.attrs.get("id") != i for i in self.ids):
            return False
        return all((have := e.attrs.get(name)) is not None and (how is None or how(have, value)) for name, how, value in self.attrs)


@lru_cache(maxsize=4096)
def _steps(selector: str) -> list[list[_Simple | str]]:
    """The alternatives of a selector, each as its steps; > between two stands for a child."""
    choices = [re.findall(r">|[^\s>\[]*(?:\[[^\]]*\][^\s>\[]*)*", s.strip()) for s in selector.split(",")]
    return [[x if x == ">" else _Simple(x) for x in c if x] for c in choices]


def _matches(e: Element, steps: list[_Simple | str], top: Element) -> bool:
    if not steps[-1].fits(e):
        return False
    rest = steps[:-1]
    if not rest:
        return True
    up = e.parent
    if rest[-1] == ">":
        return up is not None and up is not top and _matches(up, rest[:-1], top)
    while up is not None and up is not top:
        if _matches(up, rest, top):
            return True
        up = up.parent
    return False


def select(top: Element, selector: str) -> list[Element]:
    """Descendants of ``top`` in page order that a selector matches.

    Understood are tag, .class, #id, [attr], [attr=v] with ^=, $= and *=, a space
    for descendants, > for children, and a comma between alternatives.
    """
    found = {e.at: e for steps in _steps(selector) for e in top.page.inside(top, steps[-1].key) if _matches(e, steps, top)}
    return [found[i] for i in sorted(found)]


def _item(e: Element) -> dict[str, str | None]:
    link = e if "href" in e.attrs else next((x for x in e.page.inside(e, "a") if "href" in x.attrs), None)
    return {"text": e.text(), "href": link.attrs["href"] if link else e.attrs.get("src") or e.attrs.get("data") or e.attrs.get("data-bs-target"), "column": e.attrs.get("data-column-id"), "attrs": list(e.attrs.values())}


#: What an element may bring along besides its text, link, id and parts.
FIELDS = ("lines", "links", "cells")


def found_elements(page: str | None, kinds: dict[str, tuple[str, dict[str, str]]], inner: tuple[str, ...] = (), fields: tuple[str, ...] = FIELDS) -> list[dict]:
    """The elements of one page, as ``elements`` gives them."""
    root = parse(page or "")
    rows = []
    for kind, (selector, parts) in kinds.items():
        for e in select(root, selector):
            item = _item(e)
            rows.append(
                {
                    "kind": kind,
                    "position": e.at - 1,
                    "text": item["text"],
                    "href": item["href"],
                    "id": e.attrs.get("id"),
                    "inner": e.inner() if kind in inner else None,
                    "lines": e.lines() if "lines" in fields else None,
                    "links": [_item(a) for a in ([e] if e.tag == "a" else []) + e.page.inside(e, "a")] if "links" in fields else None,
                    "cells": [_item(c) for c in e.walk() if c.tag in ("td", "th") or "data-column-id" in c.attrs] if "cells" in fields else None,
                    "parts": [(p, [_item(x) for x in select(e, s)]) for p, s in parts.items()],
                }
            )
    return sorted(rows, key=lambda r: r["position"])


#: So many elements go back from Python at once (those of one page may be more), and so many in a row.
BATCH_ELEMENTS, ROW_ELEMENTS = 512, 256


def element_batches(batches: Iterable[pa.RecordBatch], find: Callable[[str | None], list[dict]], listed: pa.DataType) -> Iterator[pa.RecordBatch]:
    """Batches whose last column has pages, with a few of a page's elements (a list of the type ``listed``) in a row instead; never those of many pages at once."""
    for batch in batches:
        *kept, texts = batch.columns

        def made(at: list[int], rows: list[list[dict]]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([*(c.take(pa.array(at, pa.int64())) for c in kept), pa.array(rows, listed)], [*batch.schema.names[:-1], "element"])

        at, rows, held = [], [], 0
        for i in range(batch.num_rows):
            found = find(texts[i].as_py())
            for s in range(0, len(found), ROW_ELEMENTS):
                at.append(i)
                rows.append(found[s : s + ROW_ELEMENTS])
            held += len(found)
            if held >= BATCH_ELEMENTS:
                yield made(at, rows)
                at, rows, held = [], [], 0
        if rows:
            yield made(at, rows)


_BATCH, _BATCH_DEFAULT, _BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b", "4m"


def _small_batches(spark: SparkSession) -> None:
    """Let pages go to Python ``_BATCH_BYTES`` at a time, unless the session sets another size: with Spark's own default a task holds 64 MB of them twice."""
    if spark.conf.get(_BATCH) == _BATCH_DEFAULT:
        spark.conf.set(_BATCH, _BATCH_BYTES)


def elements(pages: DataFrame, kinds: dict[str, tuple[str, dict[str, str]]], page: str = "html", inner: tuple[str, ...] = (), fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """A row for each matched element of each page, in ``element``; the page's own column goes.

    ``kinds`` gives each kind its selector and the selectors of its parts, which
    are looked for inside.  An element that several kinds match gives a row for
    each; those of the kinds ``inner`` bring all text and attribute values inside
    along, and all of them the ``fields`` named.  A null or broken page gives what
    can be read of it, however deep.
    """
    _small_batches(pages.sparkSession)
    rest = [c for c in pages.columns if c != page]
    kind = T.DataType.fromDDL(f"array<{ELEMENT}>")
    shape, listed = T.StructType([*pages.select(*rest).schema.fields, T.StructField("element", kind)]), to_arrow_type(kind)
    found = pages.select(*rest, page).mapInArrow(lambda batches: element_batches(batches, lambda text: found_elements(text, kinds, inner, fields), listed), shape)
    return found.select(*rest, F.explode("element").alias("element"))
