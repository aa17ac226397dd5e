"""Cases from captured listing pages.

Every function takes ``pages`` with url and html and gives a row for each case.
``caselake.sources.html.elements`` finds the elements; all that follows is
expressions and windows within a page.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caselake.functions import dates, text, urls, values
from caselake.sources.html import elements

E = "element"


def _e(name: str) -> Column:
    return F.col(f"{E}.{name}")


def _part(name: str, at: int = 0, field: str = "text") -> Column:
    return F.coalesce(F.get(F.col(f"{E}.parts")[name], F.lit(at))[field], F.lit(""))


def _cell(at: int, field: str = "text") -> Column:
    """Counted from the end if negative."""
    cells = _e("cells")
    return F.coalesce((F.try_element_at(cells, F.lit(at)) if at < 0 else F.get(cells, F.lit(at)))[field], F.lit(""))


def _texts(name: str) -> Column:
    return F.filter(F.transform(F.col(f"{E}.parts")[name], lambda x: x["text"]), lambda t: t != "")


def _first_link(test) -> Column:
    return F.coalesce(F.get(F.filter(F.transform(_e("links"), lambda a: a["href"]), test), F.lit(0)), F.lit(""))


def _carried(kind: str, alias: str, rows: DataFrame, value: Column) -> DataFrame:
    """The last value of elements of ``kind`` at or before each element of the page."""
    w = Window.partitionBy("url").orderBy(_e("position")).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn(alias, F.last(F.when(_e("kind") == kind, value), ignorenulls=True).over(w))


def year_links(pages: DataFrame, level: str | None = None, status: str | None = None) -> DataFrame:
    """Links whose text begins with a year, latest first; for one court level and publication status if given."""
    rows = elements(pages, {"a": ("a[href]", {})}, fields=())
    year, href = F.regexp_extract(_e("text"), r"^(\d{4})\b", 1), _e("href")
    kept = rows.filter(year != "")
    if level:
        kept = kept.filter(F.contains(href, F.lit("byYear")) & F.contains(href, F.lit(f"crtLevel={level}")))
    if status:
        kept = kept.filter(F.contains(href, F.lit(f"pubStatus={status}")))
    return kept.select(year.cast("int").alias("year"), urls.resolved("url", href).alias("year_url")).distinct().orderBy(F.desc("year"))


def opinion_counts(pages: DataFrame, sign: str = "showOpinion") -> DataFrame:
    """How many links of each page show an opinion; pages without one have none."""
    rows = elements(pages, {"a": ("a[href]", {})}, fields=()).filter(F.contains(_e("href"), F.lit(sign)))
    return pages.select("url").distinct().join(rows.groupBy("url").agg(F.count("*").alias("n")), "url", "left").select("url", F.coalesce("n", F.lit(0).cast("bigint")).alias("n_opinions"))


def _case_rows(rows: DataFrame, *more: Column | str) -> DataFrame:
    """Rows of four cells or more as cases, with the columns ``more``."""
    rows = rows.filter(F.size(F.col(f"{E}.parts")["cell"]) >= 4)
    divided = (F.size(F.col(f"{E}.parts")["cell"]) >= 5) & _part("cell", 2).isin("I", "II", "III")
    at = lambda k: F.when(divided, _part("cell", k + 1)).otherwise(_part("cell", k))
    out = rows.select(
        "url", _e("position").alias("position"), _part("cell", 0).alias("file_date"), _part("cell", 1).alias("case_number"), F.when(divided, _part("cell", 2)).otherwise("").alias("division"),
        F.regexp_replace(at(2), r"^\*\s*", "").alias("case_title"), at(3).alias("file_contains"), _part("cell", 1, "href").alias("href"), *more,
    )
    return out.filter("case_number <> '' AND href <> ''").withColumn("case_info_url", urls.resolved("url", "href")).drop("href")


def case_tables(pages: DataFrame) -> DataFrame:
    """Rows of four cells or more: date, number, (division I to III,) title, further text.

    Rows without a number or a link go, as do headings.
    """
    return _case_rows(elements(pages, {"row": ("table tr", {"cell": "td"})}, fields=()))


def plain_case_tables(pages: DataFrame) -> DataFrame:
    """Rows of four cells or more, of either kind: date, number, title, further text; the first row of a table that has others is its heading."""
    marks = elements(pages, {"table": ("table", {"row": "tr"}), "row": ("table tr", {"cell": "td, th"})}, fields=())
    w = Window.partitionBy("url").orderBy(_e("position")).rowsBetween(Window.unboundedPreceding, 0)
    table = F.last(F.when(_e("kind") == "table", F.struct(_e("position").alias("at"), F.size(F.col(f"{E}.parts")["row"]).alias("n"))), ignorenulls=True).over(w)
    rows = marks.withColumn("table", table).filter(_e("kind") == "row")
    first = F.min(_e("position")).over(Window.partitionBy("url", "table.at"))
    rows = rows.withColumn("first", first).filter(((_e("position") > F.col("first")) | (F.col("table.n") <= 1)) & (F.size(F.col(f"{E}.parts")["cell"]) >= 4))
    out = rows.select(
        "url", _e("position").alias("position"), _part("cell", 0).alias("file_date"), _part("cell", 1).alias("case_number"), F.regexp_replace(_part("cell", 2), r"^\*\s*", "").alias("case_title"),
        _part("cell", 3).alias("file_contains"), _part("cell", 1, "href").alias("href"),
    )
    return out.filter("case_number <> '' AND href <> ''").withColumn("case_info_url", urls.resolved("url", "href")).drop("href")


def month_tables(pages: DataFrame) -> DataFrame:
    """As ``case_tables``, with the month of the heading above the table, else of the date; without either a row goes."""
    marks = elements(pages, {"month": ("h2, h3, h4", {}), "table": ("table", {}), "row": ("table tr", {"cell": "td"})}, fields=())
    marks = _carried("month", "heading", marks, text.month_in(_e("text")))
    marks = _carried("table", "above", marks, F.struct("heading"))
    cases = _case_rows(marks.filter(_e("kind") == "row"), F.col("above.heading").alias("heading"))
    return cases.withColumn("month", F.coalesce("heading", text.month_in("file_date"))).filter("month IS NOT NULL").drop("heading")


def results_table(pages: DataFrame, signs: tuple[str, ...] = ("supreme court", "court of appeal")) -> DataFrame:
    """Rows of each page's results: the first table whose headings hold all ``signs``, else its first table.

    The first cell has the number (its link's text, else its first line) and,
    in its second line, the title; the next two are numbers of other courts,
    and stand in ``named`` by their headings too.  The first row is the heading.
    """
    marks = elements(pages, {"table": ("table", {"head": "tr > th"}), "row": ("table tr", {"cell": "td"}), "cell": ("tr > td", {"link": "a"})}, fields=("lines",))
    heads = F.transform(F.col(f"{E}.parts")["head"], lambda x: x["text"])
    line = F.lower(F.array_join(heads, " "))
    fits = F.lit(True)
    for sign in signs:
        fits = fits & F.contains(line, F.lit(sign))
    tables = marks.filter(_e("kind") == "table").groupBy("url").agg(F.min_by(F.struct(_e("position").alias("at"), heads.alias("heads")), F.struct(~fits, _e("position"))).alias("chosen"))
    rows = _carried("row", "row_at", _carried("table", "table_at", marks, _e("position")), _e("position"))
    inside = rows.join(tables, "url").filter((F.col("table_at") == F.col("chosen.at")) & (_e("kind") != "table"))
    firsts = inside.groupBy("url").agg(F.min("row_at").alias("head_at"))
    inside = inside.join(firsts, "url").filter("row_at > head_at")
    lines = _e("lines")
    number = F.when(F.size(F.col(f"{E}.parts")["link"]) > 0, _part("link")).otherwise(F.coalesce(F.get(lines, F.lit(0)), F.lit("")))
    told = F.struct(number.alias("case_number"), F.coalesce(F.get(lines, F.lit(1)), F.lit("")).alias("case_title"), _part("link", 0, "href").alias("href"))
    by_row = inside.groupBy("url", "row_at", "chosen").agg(
        F.min_by(F.when(_e("kind") == "row", F.col(f"{E}.parts")["cell"]), F.when(_e("kind") == "row", _e("position"))).alias("cells"),
        F.min_by(F.when(_e("kind") == "cell", told), F.when(_e("kind") == "cell", _e("position"))).alias("first"),
    )
    value = lambda k: F.coalesce(F.get("cells", F.lit(k))["text"], F.lit(""))
    head = lambda k: text.header_name(F.coalesce(F.get("chosen.heads", F.lit(k)), F.lit(f"column_{k}")))
    pairs = F.filter(F.array(*[F.when(F.size("cells") > k, F.struct(head(k).alias("k"), value(k).alias("v"))) for k in (1, 2)]), lambda x: x.isNotNull())
    kept = by_row.filter("first IS NOT NULL AND size(cells) > 0")
    return kept.select(
        "url", F.col("row_at").alias("position"), "first.case_number", "first.case_title", F.when(F.col("first.href") != "", urls.resolved("url", "first.href")).otherwise("").alias("case_url"),
        value(1).alias("court_of_appeal_case_number"), value(2).alias("trial_court_case_number"),
        F.map_from_entries(F.when(F.get(pairs, F.lit(0))["k"] == F.get(pairs, F.lit(1))["k"], F.slice(pairs, 2, 1)).otherwise(pairs)).alias("named"),
    )


def _first(values: Column, found: Callable[[Column], Column]) -> Column:
    """What ``found`` gives for the first value for which that is neither null nor empty; else empty.  Later ones are not looked at."""
    return F.aggregate(values, F.lit(""), lambda held, x: F.when(held != "", held).otherwise(F.coalesce(found(x), F.lit(""))))


def _document(value: Column, base: Column) -> Column:
    """The address itself if it looks like a PDF's, else the first one of a PDF in the text."""
    whole = urls.bound(urls.normalized(value, base), lambda w: F.when((w != "") & urls.looks_like_pdf(w), w))
    return F.coalesce(whole, urls.pdf_in_text(value))


def address_of_element(items: Column, base: Column) -> Column:
    """Of some elements' links and the values of their attributes, in order, the first that is a PDF's address or holds one; else empty."""
    values = F.flatten(F.transform(items, lambda i: F.concat(F.array(F.coalesce(i["href"], F.lit(""))), F.coalesce(i["attrs"], F.array().cast("array<string>")))))
    return _first(values, lambda v: _document(v, base))


# Where a result's record may name its document, in order.
RECORD_KEYS = ("$.clickUri", "$.uri", "$.rawUri", "$.printableUri", "$.raw.uri", "$.raw.clickuri", "$.raw.fileuri", "$.raw.fileurl")


#: Selectors of what a result of a search holds; l0 to l5 are where its document may be linked, in order.
RESULT_PARTS = {
    "title": ".coveo-result-cell.c-title span.CoveoResultLink", "date": ".coveo-result-cell.c-date span.CoveoFieldValue span", "excerpt": "span.CoveoExcerpt",
    **{name: f"span.CoveoFieldValue[data-field=@{at}] span" for name, at in (("publication", "publicationtype"), ("source", "source"), ("size", "size"), ("pages", "syspages"), ("uri", "uri"))},
    "l0": "a.CoveoResultLink", "l1": ".coveo-result-cell.c-title a[href]", "l2": "a[href$=.pdf]", "l3": "a[href*=.pdf?]", "l4": "a[href*=.PDF]", "l5": ".CoveoResultLink", "record": "[data-result]",
}


def result_rows(pages: DataFrame, result: str = "div.coveo-list-layout.CoveoResult") -> DataFrame:
    """Results of a search: title (row_<n> without one), date, excerpt, publication, source, size, pages, PDF.

    The PDF is the first that is found in the links of the result, its title's
    link, its address field, the records that its elements carry (five at most,
    as they stand or with references resolved), and all else inside it.
    """
    rows = elements(pages, {"result": (result, RESULT_PARTS)}, inner=("result",), fields=())
    n = F.row_number().over(Window.partitionBy("url").orderBy(_e("position")))
    last = lambda name: F.coalesce(F.try_element_at(F.col(f"{E}.parts")[name], F.lit(-1))["text"], F.lit(""))
    links = F.flatten(F.array(*[F.slice(F.col(f"{E}.parts")[f"l{k}"], 1, 1) for k in range(6)]))
    records = F.flatten(F.transform(F.slice(F.col(f"{E}.parts")["record"], 1, 5), lambda x: F.flatten(F.transform(x["attrs"], lambda v: F.array(v, urls.unescaped(v))))))
    told = lambda r: _first(F.array(*[F.coalesce(F.get_json_object(r, k), F.lit("")) for k in RECORD_KEYS]), lambda v: urls.normalized(v, F.col("url")))
    # in order, each looked at only if those before have no address
    pdf = text.first_filled(address_of_element(links, F.col("url")), urls.normalized(_part("uri"), F.col("url")), _first(records, told), urls.pdf_in_text(_e("inner")))
    return rows.withColumn("n", n).select(
        "url", F.col("n").alias("row"), F.coalesce(text.first_filled(_part("title")), F.concat(F.lit("row_"), F.col("n").cast("string"))).alias("title"), _part("date").alias("date"), _part("excerpt").alias("excerpt"),
        *[last(c).alias(c) for c in ("publication", "source", "size", "pages")], F.coalesce(pdf, F.lit("")).alias("pdf_url"),
    )


def result_cards(pages: DataFrame) -> DataFrame:
    """Cards of a search: number (else the doc_no of its link), court and kind, title, date, first PDF."""
    rows = elements(pages, {"card": ("div.result-excerpt", {"number": ".case-number", "title": ".title, h3", "date": ".date", "notation": ".notation", "link": "a[href]"})}, fields=("links",))
    info = urls.resolved("url", _part("link", 0, "href"))
    number = F.coalesce(text.first_filled(_part("number")), urls.parameter(_part("link", 0, "href"), "doc_no"), F.lit(""))
    both = text.split_once(_part("notation"), "•")
    pdf = _first_link(lambda h: (F.contains(h, F.lit("/opinions/documents/")) & F.contains(F.lower(h), F.lit(".pdf"))) | F.endswith(F.lower(h), F.lit(".pdf")))
    out = rows.select(
        "url", number.alias("case_number"), _part("date").alias("date"), text.strip(F.get(both, F.lit(0))).alias("court"), text.strip(F.coalesce(F.get(both, F.lit(1)), F.lit(""))).alias("opinion_type"),
        _part("title").alias("title"), F.when(_part("link", 0, "href") != "", info).otherwise("").alias("case_info_url"), F.when(pdf != "", urls.resolved("url", pdf)).otherwise("").alias("pdf_url"),
    )
    return out.filter("case_number <> ''")


def badge_cards(pages: DataFrame, card: str = "article.w-100 div.card.mb-3") -> DataFrame:
    """Cards with a number and a court as badges; the description is the body of the dialog they point to."""
    rows = elements(pages, {"card": (card, {"badge": ".badge", "title": ".card-title", "link": ".card-title a[href]", "date": "time, .date", "pdf": "a[href*=.pdf]", "target": "[data-bs-target]"}), "dialog": (".modal[id]", {"p": ".modal-body p"})}, fields=())
    dialogs = rows.filter(_e("kind") == "dialog").select("url", _e("id").alias("dialog"), F.array_join(_texts("p"), " ").alias("description"))
    cards = rows.filter(_e("kind") == "card").select(
        "url", _e("position").alias("position"), _part("date").alias("date"), _part("badge", 0).alias("no"), _part("badge", 1).alias("court"), _part("title").alias("case_name"),
        urls.resolved("url", _part("link", 0, "href")).alias("page_url"), F.when(_part("pdf", 0, "href") != "", urls.resolved("url", _part("pdf", 0, "href"))).otherwise("").alias("pdf_url"),
        F.regexp_extract(_part("target", 0, "href"), "#(.+)$", 1).alias("dialog"),
    )
    return cards.join(dialogs, ["url", "dialog"], "left").drop("dialog").withColumn("description", F.coalesce("description", F.lit("")))


def dated_articles(pages: DataFrame, court: str | None = None) -> DataFrame:
    """Articles whose filled spans are court, docket and status, or docket and status if ``court`` is given."""
    rows = elements(pages, {"article": ("article", {"span": "span", "title": "h2, h3", "link": "h2 a[href], h3 a[href]", "text": "p", "pdf": "a[href*=.pdf]", "zip": "a[href*=.zip]", "date": "time, .date"})}, fields=())
    spans, n = _texts("span"), F.size(_texts("span"))
    at = lambda k: F.coalesce(F.get(spans, F.lit(k)), F.lit(""))
    last = F.coalesce(F.try_element_at(spans, F.lit(-1)), F.lit(""))
    linked = lambda p: F.when(_part(p, 0, "href") != "", urls.resolved("url", _part(p, 0, "href"))).otherwise("")
    return rows.select(
        "url", _part("date").alias("date"), (F.lit(court) if court else at(0)).alias("court"), (last if court else F.when(n >= 2, last).otherwise("")).alias("status"),
        (at(0) if court else F.when(n >= 3, at(1)).otherwise("")).alias("docket"), _part("title").alias("case_name"), _part("text").alias("description"),
        urls.resolved("url", _part("link", 0, "href")).alias("page_url"), linked("pdf").alias("pdf_url"), linked("zip").alias("zip_url"),
    )


def metadata_items(pages: DataFrame, item: str = "li.result") -> DataFrame:
    """Items with a line of metadata: court, date and, joined by bars, the rest."""
    rows = elements(pages, {"item": (item, {"id": ".case-id", "title": ".title", "link": "a[href]", "meta": ".meta"})}, fields=())
    meta = F.transform(F.col(f"{E}.parts")["meta"], lambda x: x["text"])
    return rows.select(
        "url", _part("id").alias("case_id"), _part("title").alias("title"), F.coalesce(F.get(meta, F.lit(0)), F.lit("")).alias("court"), F.coalesce(F.get(meta, F.lit(1)), F.lit("")).alias("date"),
        F.array_join(F.slice(meta, F.lit(3), F.greatest(F.size(meta), F.lit(1))), " | ").alias("citation"), urls.resolved("url", _part("link", 0, "href")).alias("detail_url"),
    )


def grid_rows(pages: DataFrame, row: str = "[role=row]") -> DataFrame:
    """Rows of a grid by the number of their columns; the last PDF in a cell wins, else one of the row."""
    rows = elements(pages, {"row": (row, {})}, fields=("links", "cells"))
    by = lambda k: F.coalesce(F.get(F.filter(_e("cells"), lambda c: c["column"] == str(k)), F.lit(0))["text"], F.lit(""))
    pdfs = lambda c: F.filter(F.transform(c, lambda x: x["href"]), lambda h: F.contains(F.lower(h), F.lit(".pdf")))
    pdf = F.coalesce(F.try_element_at(pdfs(_e("cells")), F.lit(-1)), F.get(pdfs(_e("links")), F.lit(0)))
    return rows.filter(F.size(_e("cells")) > 0).select(
        "url", _e("position").alias("position"), by(1).alias("release_date"), by(2).alias("court"), by(3).alias("case_no"), by(4).alias("case_name"), by(5).alias("disposition"),
        F.when(pdf.isNotNull(), urls.resolved("url", pdf)).otherwise("").alias("pdf_url"),
    )


def sectioned_items(pages: DataFrame, pattern: str = r"\b(S\d{2}[A-Z]\d{4})\b") -> DataFrame:
    """Items below a month and a date, both carried forward; a row for each case number in an item.

    An item needs a date above it, a PDF and a case number.
    """
    rows = elements(pages, {"month": ("h3", {}), "date": ("p > strong", {}), "item": ("ul > li", {})}, fields=("links",))
    rows = _carried("date", "date", _carried("month", "month", rows, _e("text")), text.before_dash(_e("text")))
    pdf = _first_link(lambda h: F.contains(F.lower(h), F.lit(".pdf")))
    items = rows.filter((_e("kind") == "item") & F.col("date").isNotNull() & (pdf != ""))
    return items.select("url", "month", "date", F.explode(text.case_numbers(_e("text"), pattern)).alias("case_id"), text.case_title(_e("text")).alias("case_title"), urls.resolved("url", pdf).alias("pdf_url"))


def term_links(pages: DataFrame) -> DataFrame:
    """Links to the pages of single terms, latest first."""
    rows = elements(pages, {"a": ("a[href]", {})}, fields=()).filter(F.regexp_like(_e("href"), F.lit(r"(?:^|/)slipopinion/\d{2}/?$")))
    nn = F.regexp_extract(_e("href"), r"(\d{2})/?$", 1).cast("int")
    return rows.select(urls.resolved("url", _e("href")).alias("term_url"), nn.alias("nn")).distinct().orderBy(F.desc("nn"))


def term_rows(pages: DataFrame) -> DataFrame:
    """Opinions of a term: number, date (M/D/YY), docket, name, justice and citation; headings and revisions go."""
    marks = pages.withColumn("term_year", dates.term_year("html", "url"))
    rows = elements(marks, {"row": ("tr", {"cell": "td"})}, fields=("links",)).filter(F.size(F.col(f"{E}.parts")["cell"]) >= 5)
    head = (F.lower(_part("cell", 0)) == "r-") | F.startswith(_e("text"), F.lit("Revisions:"))
    link = _first_link(lambda h: F.contains(F.lower(h), F.lit(".pdf")))
    cells = F.transform(F.col(f"{E}.parts")["cell"], lambda x: x["text"])
    back = lambda k: F.coalesce(F.try_element_at(cells, F.lit(-k)), F.lit(""))
    kept = rows.filter(~head & dates.is_short_date(_part("cell", 1)) & (link != ""))
    return kept.select("url", "term_year", _e("position").alias("position"), _part("cell", 0).alias("r_number"), _part("cell", 1).alias("date"), _part("cell", 2).alias("docket"), _part("cell", 3).alias("name"), back(2).alias("justice"), back(1).alias("citation"), urls.resolved("url", link).alias("pdf_url"))


def next_pages(pages: DataFrame) -> DataFrame:
    """The address each page names as the next one."""
    rows = elements(pages, {"next": ("a[rel=next], link[rel=next]", {}), "other": (".pager-next a[href], a.next", {})}, fields=())
    best = rows.groupBy("url").agg(F.min_by(_e("href"), F.struct(_e("kind"), _e("position"))).alias("href"))
    return best.select("url", urls.resolved("url", "href").alias("next_url"))


def pdf_links(pages: DataFrame) -> DataFrame:
    """The PDF of each page: of a slip opinion, else the first link, frame or address in the markup, else made from filename=."""
    rows = elements(pages, {"link": ("a[href], embed[src], iframe[src], object[data]", {})}, fields=())
    pdf = F.coalesce(_e("href"), F.lit(""))
    rank = F.when(F.contains(F.lower(_e("text")), F.lit("slip opinion")) & urls.looks_like_pdf(pdf), 0).when(urls.looks_like_pdf(pdf), 1)
    best = rows.withColumn("rank", rank).filter("rank IS NOT NULL").groupBy("url").agg(F.min_by(_e("href"), F.struct("rank", _e("position"))).alias("href"))
    named = urls.parameter("url", "filename")
    made = F.when(named.isNotNull(), F.concat(F.regexp_extract("url", r"^([a-z]+://[^/?#]*)", 1), F.lit("/opinions/pdf/"), text.without_final_capitals(named), F.lit(".pdf")))
    return pages.join(best, "url", "left").select("url", F.coalesce(F.when(F.col("href").isNotNull(), urls.resolved("url", "href")), urls.pdf_in_text("html"), made).alias("pdf_url"))


def page_state(pages: DataFrame) -> DataFrame:
    """Whether a page was refused, its result count and record range."""
    return pages.select("url", text.looks_blocked("html").alias("blocked"), values.result_count("html").alias("n_results"), values.page_counts(F.regexp_replace("html", "<[^>]*>", "")).alias("records"))
