"""Listing extractors as table functions for SQL.

``SELECT p.url, c.* FROM pages AS p, LATERAL listed_cards(p.html, p.url) AS c``
reads each page where it is, without a shuffle.  Rows are those of the functions
of the same meaning in ``listings``; a null page has none.
``carry_forward(TABLE(t) PARTITION BY k ORDER BY (o), ...)`` hands values on from
row to row of any table.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from urllib.parse import parse_qs, unquote, urljoin, urlsplit

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.functions import udtf
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult

from caselake.functions.text import MONTHS
from caselake.plans.listings import RECORD_KEYS, RESULT_PARTS
from caselake.sources.html import found_elements

#: Extractors by their SQL names: columns, and the rows of a page.
EXTRACTORS: dict[str, tuple[str, Callable[[str, str], Iterator[tuple]]]] = {}


def extractor(columns: str) -> Callable:
    """Registers a function from html and url to rows of ``columns``: names, each text unless a type follows it."""

    def add(rows: Callable[[str, str], Iterator[tuple]]) -> Callable:
        EXTRACTORS[rows.__name__] = (columns, rows)
        return rows

    return add


class _Seen:
    """An element with its parts at hand; addresses are seen from the page's."""

    def __init__(self, element: dict, url: str) -> None:
        self.parts, self.url = dict(element["parts"]), url
        self.kind, self.text, self.at, self.href, self.id = (element[k] for k in ("kind", "text", "position", "href", "id"))
        self.links, self.cells, self.lines = (element[k] or [] for k in ("links", "cells", "lines"))
        self.inner = element["inner"] or ""

    def of(self, name: str, at: int = 0, field: str = "text") -> str:
        found = self.parts.get(name, [])
        return (found[at][field] or "") if -len(found) <= at < len(found) else ""

    def texts(self, name: str) -> list[str]:
        return [x["text"] for x in self.parts[name] if x["text"]]

    def seen(self, href: str | None) -> str:
        return urljoin(self.url, href) if href else ""

    def link(self, test: Callable[[str], bool]) -> str:
        return next((x["href"] for x in self.links if x["href"] is not None and test(x["href"])), "")


def _elements(html: str, url: str, kinds: dict, fields: tuple[str, ...] = (), inner: tuple[str, ...] = ()) -> Iterator[_Seen]:
    return (_Seen(e, url) for e in found_elements(html, kinds, inner, fields))


def _month(t: str) -> str | None:
    return next((m.capitalize() for m in MONTHS if m[:3] in t.lower()), None)


def _is_pdf(href: str) -> bool:
    return ".pdf" in href.lower()


@extractor("year int, year_url")
def listed_years(html: str, url: str) -> Iterator[tuple]:
    """Links whose text begins with a year, each once."""
    found = ((re.match(r"(\d{4})\b", e.text, re.ASCII), e) for e in _elements(html, url, {"a": ("a[href]", {})}))
    yield from dict.fromkeys((int(m[1]), urljoin(url, e.href)) for m, e in found if m)


def _case(e: _Seen) -> tuple | None:
    if len(e.parts["cell"]) < 4:
        return None
    divided = int(len(e.parts["cell"]) >= 5 and e.of("cell", 2) in ("I", "II", "III"))
    number, href = e.of("cell", 1), e.of("cell", 1, "href")
    title = re.sub(r"^\*\s*", "", e.of("cell", 2 + divided), flags=re.ASCII)
    return (e.at, e.of("cell", 0), number, e.of("cell", 2) if divided else "", title, e.of("cell", 3 + divided), urljoin(e.url, href)) if number and href else None


@extractor("position int, file_date, case_number, division, case_title, file_contains, case_info_url, month")
def listed_case_tables(html: str, url: str) -> Iterator[tuple]:
    """Rows of four cells or more, with the month of the heading above their table, else of their date."""
    heading = above = None
    for e in _elements(html, url, {"month": ("h2, h3, h4", {}), "table": ("table", {}), "row": ("table tr", {"cell": "td"})}):
        if e.kind == "month":
            heading = _month(e.text) or heading
        elif e.kind == "table":
            above = heading
        elif (row := _case(e)) and (month := above or _month(row[1])):
            yield *row, month


@extractor("case_number, date, court, opinion_type, title, case_info_url, pdf_url")
def listed_cards(html: str, url: str) -> Iterator[tuple]:
    """Cards of a search that have a number."""
    for e in _elements(html, url, {"card": ("div.result-excerpt", {"number": ".case-number", "title": ".title, h3", "date": ".date", "notation": ".notation", "link": "a[href]"})}, ("links",)):
        href = e.of("link", 0, "href")
        court, _, kind = e.of("notation").partition("•")
        pdf = e.link(lambda h: "/opinions/documents/" in h and _is_pdf(h) or h.lower().endswith(".pdf"))
        if number := e.of("number") or parse_qs(urlsplit(href).query, separator="&").get("doc_no", [""])[0]:
            yield number, e.of("date"), court.strip(), kind.strip(), e.of("title"), e.seen(href), e.seen(pdf)


@extractor("position int, date, no, court, case_name, page_url, pdf_url, description")
def listed_badges(html: str, url: str) -> Iterator[tuple]:
    """Cards with badges; the description is the body of the dialog they point to."""
    parts = {"badge": ".badge", "title": ".card-title", "link": ".card-title a[href]", "date": "time, .date", "pdf": "a[href*=.pdf]", "target": "[data-bs-target]"}
    found = list(_elements(html, url, {"card": ("article div.card", parts), "dialog": (".modal[id]", {"p": ".modal-body p"})}))
    dialogs = {e.id: " ".join(e.texts("p")) for e in found if e.kind == "dialog"}
    for e in (e for e in found if e.kind == "card"):
        yield e.at, e.of("date"), e.of("badge"), e.of("badge", 1), e.of("title"), urljoin(url, e.of("link", 0, "href")), e.seen(e.of("pdf", 0, "href")), dialogs.get(e.of("target", 0, "href").partition("#")[2], "")


@extractor("date, court, status, docket, case_name, description, page_url, pdf_url, zip_url")
def listed_articles(html: str, url: str) -> Iterator[tuple]:
    """Articles whose filled spans are court, docket and status."""
    parts = {"span": "span", "title": "h2, h3", "link": "h2 a[href], h3 a[href]", "text": "p", "pdf": "a[href*=.pdf]", "zip": "a[href*=.zip]", "date": "time, .date"}
    for e in _elements(html, url, {"article": ("article", parts)}):
        spans = e.texts("span")
        court, status, docket = spans[0] if spans else "", spans[-1] if len(spans) >= 2 else "", spans[1] if len(spans) >= 3 else ""
        yield e.of("date"), court, status, docket, e.of("title"), e.of("text"), urljoin(url, e.of("link", 0, "href")), e.seen(e.of("pdf", 0, "href")), e.seen(e.of("zip", 0, "href"))


@extractor("position int, release_date, court, case_no, case_name, disposition, pdf_url")
def listed_grid(html: str, url: str) -> Iterator[tuple]:
    """Rows of a grid by the number of their columns; the last PDF in a cell wins, else the first of the row."""
    for e in _elements(html, url, {"row": ("[role=row]", {})}, ("links", "cells")):
        if e.cells:
            inside = [c["href"] for c in e.cells if c["href"] and _is_pdf(c["href"])]
            by = lambda k: next((c["text"] for c in e.cells if c["column"] == str(k)), "")
            yield e.at, by(1), by(2), by(3), by(4), by(5), e.seen(inside[-1] if inside else e.link(_is_pdf))


@extractor("month, date, case_id, case_title, pdf_url")
def listed_sections(html: str, url: str) -> Iterator[tuple]:
    """Items below a month and a date, a row for each case number in an item."""
    number = re.compile(r"\bS[0-9]{2}[A-Z][0-9]{4}\b", re.ASCII)
    month = date = None
    for e in _elements(html, url, {"month": ("h3", {}), "date": ("p > strong", {}), "item": ("ul > li", {})}, ("links",)):
        if e.kind == "month":
            month = e.text
        elif e.kind == "date":
            date = next((left for dash in "—–-" if dash in e.text and (left := e.text.partition(dash)[0].strip())), e.text)
        elif date is not None and (pdf := e.link(_is_pdf)):
            _, cut, after = e.text.partition(". ")
            title = after.strip() if cut else number.sub("", e.text).strip(" ,.")
            for case in number.findall(e.text):
                yield month, date, case, title, urljoin(url, pdf)


@extractor("term_year int, position int, r_number, date, docket, name, justice, citation, pdf_url")
def listed_terms(html: str, url: str) -> Iterator[tuple]:
    """Opinions of a term; headings and revisions go."""
    named, ends = re.search(r"(?i)Term Year:\s*([0-9]{4})", html), re.search(r"/([0-9]{2})/?$", url)
    year = int(named[1]) if named else 2000 + int(ends[1]) if ends else None
    for e in _elements(html, url, {"row": ("tr", {"cell": "td"})}, ("links",)):
        at = lambda k: e.of("cell", k)
        pdf = e.link(_is_pdf)
        if len(e.parts["cell"]) >= 5 and at(0).lower() != "r-" and not e.text.startswith("Revisions:") and re.fullmatch("[0-9]{1,2}/[0-9]{1,2}/[0-9]{2}", at(1)) and pdf:
            yield year, e.at, at(0), at(1), at(2), at(3), at(-2), at(-1), urljoin(url, pdf)


@extractor("n_opinions bigint")
def listed_opinion_counts(html: str, url: str) -> Iterator[tuple]:
    """How many links of the page show an opinion."""
    yield (sum("showOpinion" in (e.href or "") for e in _elements(html, url, {"a": ("a[href]", {})})),)


@extractor("position int, file_date, case_number, case_title, file_contains, case_info_url")
def listed_plain_tables(html: str, url: str) -> Iterator[tuple]:
    """Rows of four cells or more of either kind; the first row of a table that has others is its heading."""
    rows, first = 0, None
    for e in _elements(html, url, {"table": ("table", {"row": "tr"}), "row": ("table tr", {"cell": "td, th"})}):
        if e.kind == "table":
            rows, first = len(e.parts["row"]), None
            continue
        heading, first = first is None and rows > 1, e.at if first is None else first
        number, href = e.of("cell", 1), e.of("cell", 1, "href")
        if not heading and len(e.parts["cell"]) >= 4 and number and href:
            yield e.at, e.of("cell"), number, re.sub(r"^\*\s*", "", e.of("cell", 2), flags=re.ASCII), e.of("cell", 3), urljoin(url, href)


def _column(heading: str) -> str:
    return re.sub(r"\s+", "_", heading.lower().replace("#", "no").strip()).strip("_")


@extractor("position int, case_number, case_title, case_url, court_of_appeal_case_number, trial_court_case_number, named map")
def listed_results(html: str, url: str) -> Iterator[tuple]:
    """Rows of the page's results: the first table whose headings hold both signs, else its first one."""
    signs = ("supreme court", "court of appeal")
    found = list(_elements(html, url, {"table": ("table", {"head": "tr > th"}), "row": ("table tr", {"cell": "td"}), "cell": ("tr > td", {"link": "a"})}, ("lines",)))
    heads = lambda e: [x["text"] for x in e.parts["head"]]
    tables = [e for e in found if e.kind == "table"]
    chosen = min(tables, key=lambda e: (not all(s in " ".join(heads(e)).lower() for s in signs), e.at), default=None)
    table, row, cells = None, None, {}
    rows: dict[int, tuple[_Seen, list[_Seen]]] = {}
    for e in found:
        if e.kind == "table":
            table = e
        elif e.kind == "row":
            row = e
            if table is chosen:
                rows[e.at] = (e, [])
        elif row is not None and table is chosen and row.at in rows:
            rows[row.at][1].append(e)
    for at in sorted(rows)[1:]:
        row, firsts = rows[at]
        cells = [x["text"] for x in row.parts["cell"]]
        if not cells or not firsts:
            continue
        one = firsts[0]
        number = one.of("link") if one.parts["link"] else (one.lines or [""])[0]
        named = {_column(heads(chosen)[k] if k < len(heads(chosen)) else f"column_{k}"): cells[k] for k in (1, 2) if len(cells) > k}
        value = lambda k: cells[k] if len(cells) > k else ""
        yield at, number, one.lines[1] if len(one.lines) > 1 else "", one.seen(one.of("link", 0, "href")), value(1), value(2), named


def _web(value: str, base: str) -> str:
    """The address if it is one of the web, else empty."""
    bare = value.strip()
    whole = f"https:{bare}" if bare.startswith("//") else urljoin(base, bare)
    return whole if bare and re.match("https?://[^/?#]", whole, re.IGNORECASE) else ""


def _unescaped(text: str) -> str:
    """The five references that markup needs, resolved."""
    for name, sign in (("&quot;", '"'), ("&#39;", "'"), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")):
        text = text.replace(name, sign)
    return text


def _pdf_in(text: str) -> str:
    """The first address of a PDF in running text or markup."""
    found = re.search(r"""https?://[^\s"'<>]+?\.pdf[^\s"'<>]*""", _unescaped(text), re.IGNORECASE | re.ASCII)
    return found[0] if found else ""


def _document(value: str, base: str) -> str:
    """The address itself if it looks like a PDF's, else the first one in the text."""
    whole = _web(value, base)
    split = urlsplit(whole)
    looks = ".pdf" in unquote(f"{split.path}?{split.query}").lower() or any(x in whole.lower() for x in ("filetype=pdf", "format=pdf"))
    return whole if whole and looks else _pdf_in(value)


def _told(record: str, base: str) -> str:
    """The first address in a result's record, where it is one."""
    for path in RECORD_KEYS:
        try:
            at = json.loads(record)
            for step in path.split(".")[1:]:
                at = at[step]
        except (ValueError, KeyError, TypeError, IndexError):
            continue
        if at is not None and (found := _web(str(at), base)):
            return found
    return ""


@extractor("row int, title, date, excerpt, publication, source, size, pages, pdf_url")
def listed_search(html: str, url: str) -> Iterator[tuple]:
    """Results of a search; the PDF is the first of their links, address field, records and all else inside."""
    kinds = {"result": ("div.coveo-list-layout.CoveoResult", RESULT_PARTS)}
    for n, e in enumerate(_elements(html, url, kinds, inner=("result",)), 1):
        links = [v for k in range(6) for x in e.parts[f"l{k}"][:1] for v in (x["href"] or "", *x["attrs"])]
        records = [r for x in e.parts["record"][:5] for v in x["attrs"] for r in (v, _unescaped(v))]
        ways = (*((_document, v) for v in links), (_web, e.of("uri")), *((_told, r) for r in records))
        pdf = next((found for way, v in ways if (found := way(v, url))), "") or _pdf_in(e.inner)
        yield n, e.of("title") or f"row_{n}", e.of("date"), e.of("excerpt"), *(e.of(c, -1) for c in ("publication", "source", "size", "pages")), pdf


@extractor("case_id, title, court, date, citation, detail_url")
def listed_items(html: str, url: str) -> Iterator[tuple]:
    """Items with a line of metadata: court, date and the rest."""
    for e in _elements(html, url, {"item": ("li.result", {"id": ".case-id", "title": ".title", "link": "a[href]", "meta": ".meta"})}):
        meta = [x["text"] for x in e.parts["meta"]]
        yield e.of("id"), e.of("title"), e.of("meta"), e.of("meta", 1), " | ".join(meta[2:]), urljoin(url, e.of("link", 0, "href"))


@extractor("term_url, nn int")
def listed_term_links(html: str, url: str) -> Iterator[tuple]:
    """Links to the pages of single terms, each once."""
    found = ((re.search(r"(?:^|/)slipopinion/([0-9]{2})/?$", e.href or ""), e) for e in _elements(html, url, {"a": ("a[href]", {})}))
    yield from dict.fromkeys((urljoin(url, e.href), int(m[1])) for m, e in found if m)


@extractor("next_url")
def listed_next(html: str, url: str) -> Iterator[tuple]:
    """The address that the page names as the next one."""
    found = _elements(html, url, {"next": ("a[rel=next], link[rel=next]", {}), "other": (".pager-next a[href], a.next", {})})
    if (best := min(found, key=lambda e: (e.kind, e.at), default=None)) is not None:
        yield (urljoin(url, best.href or ""),)


def _typed(columns: str) -> T.StructType:
    """Names, each with a type or text, as a schema; without a session, as workers have none."""
    kinds = {"int": T.IntegerType(), "bigint": T.LongType(), "map": T.MapType(T.StringType(), T.StringType()), "": T.StringType()}
    return T.StructType([T.StructField(name, kinds[kind]) for name, _, kind in (c.strip().partition(" ") for c in columns.split(","))])


def _function(columns: str, rows: Callable[[str, str], Iterator[tuple]]) -> type:
    class Listing:
        @staticmethod
        def analyze(html: AnalyzeArgument, url: AnalyzeArgument) -> AnalyzeResult:
            for name, a in (("html", html), ("url", url)):
                if not isinstance(a.dataType, (T.StringType, T.NullType)):
                    raise ValueError(f"{name} must be a string, not {a.dataType.simpleString()}")
            return AnalyzeResult(_typed(columns))

        def eval(self, html: str, url: str) -> Iterator[tuple]:
            if html is not None:
                yield from rows(html, url or "")

    return Listing


class CarryForward:
    """``carry_forward(TABLE(t) PARTITION BY k ORDER BY (o), 'value', 'name')``: each row, and the last ``value`` that is not null at or before it as ``name``."""

    @staticmethod
    def analyze(rows: AnalyzeArgument, value: AnalyzeArgument, name: AnalyzeArgument) -> AnalyzeResult:
        if not rows.isTable:
            raise ValueError("the first argument must be a table")
        if value.value not in rows.dataType.names:
            raise ValueError(f"the table has no column {value.value}")
        if name.value in rows.dataType.names:
            raise ValueError(f"the table has a column {name.value} already")
        return AnalyzeResult(T.StructType([*rows.dataType.fields, T.StructField(name.value, rows.dataType[value.value].dataType)]))

    def __init__(self) -> None:
        self.last = None

    def eval(self, rows, value: str, name: str) -> Iterator[tuple]:
        now = rows[value]
        self.last = self.last if now is None else now
        yield *rows, self.last


def register_tables(spark: SparkSession) -> list[str]:
    """Register all table functions of this module for the session; their names."""
    for name, (columns, rows) in EXTRACTORS.items():
        spark.udtf.register(name, udtf(_function(columns, rows)).asDeterministic())
    spark.udtf.register("carry_forward", udtf(CarryForward))
    return [*EXTRACTORS, "carry_forward"]


def read_by(name: str) -> Callable[[DataFrame], DataFrame]:
    """The extractor ``name`` as a function of pages (url, html), by SQL."""

    def read(pages: DataFrame) -> DataFrame:
        register_tables(pages.sparkSession)
        return pages.sparkSession.sql(f"SELECT p.url, c.* FROM {{pages}} AS p, LATERAL {name}(p.html, p.url) AS c", pages=pages)

    return read
