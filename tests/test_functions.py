import datetime

import pytest
from pyspark.sql import functions as F

from caselake.functions import dates, text, urls, values


def one(spark, expr, value=None, **more):
    df = spark.createDataFrame([(value,)], "x string")
    return df.select(expr.alias("y")).first()[0]


X = "x"
LONG = "ab " * 150


@pytest.mark.parametrize(
    ("f", "value", "want"),
    [
        (text.slugify, None, "unknown"), (text.slugify, " \t ", "unknown"), (text.slugify, "---", "unknown"), (text.slugify, "É a_b-c!", "é-a-b-c"), (text.slugify, "a b", "a-b"), (text.slugify, LONG, "-".join(["ab"] * 20)),
        (text.folder_name, 'a/b\\c:d*e?f"g<h>i|j', "abcdefghij"), (text.folder_name, "-.x y.-", "x-y"), (text.folder_name, None, ""),
        (text.masked_name, "a/b:c", "a_b_c"), (text.word_name, " a  b! ", "a_b"), (text.run_masked_name, "a//b  c ", "a_b c"), (text.listed_name, "//", "file"), (text.listed_name, "._x_.", "x"),
        (text.clean_ws, " a \n b ", "a b"), (text.clean_ws, None, ""), (text.header_name, " Case # Number ", "case_no_number"),
        (text.before_dash, "January 5 — SUMMARIES", "January 5"), (text.before_dash, "a-b–c", "a-b"), (text.before_dash, "—x", "—x"), (text.month_in, "Filed in SEPT. and March", "March"), (text.month_in, "none", None),
        (text.without_final_capitals, "871051MAJ", "871051"), (text.case_numbers, "S24A0001, S24A0001. Doe v. State", ["S24A0001", "S24A0001"]), (text.case_title, "S24A0001. Doe v. State. More", "Doe v. State. More"), (text.case_title, "S24A0001, Doe", "Doe"),
        (text.looks_blocked, "Request Rejected", True), (text.looks_blocked, "support ID: 1", False), (text.looks_blocked, "Support ID, rejected", True), (text.looks_blocked, None, False),
        (dates.long_date, "Jan. 16, 2025", datetime.date(2025, 1, 16)), (dates.long_date, "Sept. 5, 2024", datetime.date(2024, 9, 5)), (dates.long_date, "September 5, 2024", datetime.date(2024, 9, 5)), (dates.long_date, "13/40/2026", None), (dates.long_date, "", None),
        (dates.is_short_date, "1/14/26", True), (dates.is_short_date, "1/14/2026", False), (dates.short_date, "13/40/26", None), (dates.short_date, "1/9/26", datetime.date(2026, 1, 9)), (dates.leading_year, "abcd", None), (dates.leading_year, "2020-01-01", 2020),
        (values.flag, "t", True), (values.flag, "true", False), (values.flag, None, False), (values.whole_number, " 12 ", 12), (values.whole_number, "x", None), (values.grouped_number, "1,234", 1234), (values.byte_size, "132.67 KB", 135854), (values.result_count, "1-10 of 1,234 results", 1234), (values.result_count, "", 0),
        (urls.is_http, "mailto:a@b", False), (urls.is_http, "HTTPS://a/b", True), (urls.is_pdf, "http://a/b%2Epdf", True), (urls.is_pdf, "http://a/b%", False), (urls.looks_like_pdf, "http://a/b?FileType=pdf", True), (urls.base_name, "http://a/b/c.PDF?x=1", "c.PDF"), (urls.host, "http://A.b/c", "a.b"),
        (urls.pdf_in_text, 'x &quot;https://a/b.PDF?x=1&amp;y=2&quot; z', "https://a/b.PDF?x=1&y=2"), (urls.pdf_in_text, "none", None),
    ],
)
def test_values(spark, f, value, want):
    assert one(spark, f(X), value) == want


def test_parameters(spark):
    assert one(spark, urls.parameter(X, "k"), "http://a/?k=a%20b&k=c#d") == "a b"
    assert one(spark, urls.parameter(X, "k"), "http://a/?k=#d") is None
    assert one(spark, urls.with_parameter(X, "start", F.lit(51)), "http://a/?start=1&x=2") == "http://a/?start=51&x=2"
    assert one(spark, urls.with_parameter(X, "start", F.lit(51)), "http://a/b#c") == "http://a/b?start=51#c"


@pytest.mark.parametrize("href", ["/x/y", "z.html", "../up", "//other/x", "https://e.org/q", "?p=1", "#top", "", "/a/../b"])
def test_resolution_is_that_of_the_standard(spark, href):
    from urllib.parse import urljoin

    base = "http://h.example/a/b/c?d=1"
    assert one(spark, urls.resolved(F.lit(base), X), href) == urljoin(base, href)


def test_normalized(spark):
    assert one(spark, urls.normalized(X, "https://b.example/q/"), " //c.example/x ") == "https://c.example/x"
    assert one(spark, urls.normalized(X, "https://b.example/q/"), "mailto:x@y") == ""
    assert one(spark, urls.normalized(X, "https://b.example/q/"), "r.pdf") == "https://b.example/q/r.pdf"


@pytest.mark.parametrize(("number", "filed", "want"), [("20-1234", "", "2020"), ("85-1234", None, "1985"), ("2019-1234", "", "2019"), ("x", "2021-05-01", "2021"), ("x", "", None), ("20-1", "abc", "2020")])
def test_docket_year(spark, number, filed, want):
    assert one(spark, dates.docket_year(F.lit(number), F.lit(filed).cast("string"))) == want


def test_term_year(spark):
    assert one(spark, dates.term_year(F.lit("Term Year: 2023"), F.lit("/slipopinion/24/"))) == 2023
    assert one(spark, dates.term_year(F.lit(""), F.lit("http://x/slipopinion/24"))) == 2024


def test_text_choices(spark):
    s = lambda v: F.lit(v).cast("string")
    assert one(spark, text.first_filled(s(""), s(None), s("b"))) == "b"
    assert one(spark, text.best_text(s(" \n"), s(None), s(" x "))) == " x "
    assert one(spark, text.best_text(s(None))) == ""
    assert one(spark, text.joined("|", s(""), s(None), default="no-file")) == "no-file"
    assert one(spark, text.joined(";", s("a"), s(""), s("b"))) == "a;b"
    assert one(spark, text.split_once(s("a • b • c"), " • ")) == ["a", "b • c"]
    assert one(spark, text.record_folder(s("20-1"), s(""), s("7"), s("Doe v. Roe"), s(""))) == "20-1_doe-v-roe"
    assert one(spark, text.record_folder(s(""), s(None), s("7"), s(""), s(None))) == "7"


def test_bodies(spark):
    b = lambda v: F.lit(bytearray(v))
    assert one(spark, text.is_html_instead(b(b"<!DOCTYPE HTML><html>"))) is True
    assert one(spark, text.is_html_instead(b(b"%PDF-1.4" + b"x" * 2000))) is False
    assert one(spark, text.is_too_small(b(b"x"))) is True
    assert one(spark, values.percent(F.lit(1), F.lit(3))) == 33.3
    assert one(spark, values.percent(F.lit(1), F.lit(0))) == 0.0
    r = one(spark, values.page_counts(X), "1 - 4 of 1,204 Records Found.")
    assert (r["first"], r["last"], r["total"]) == (1, 4, 1204)


def test_a_name_of_a_long_text_is_worked_out_once_of_its_beginning(spark):
    from pyspark.sql import functions as F

    texts = ["a" * 1000, "?" * 15 + "b" * 985, "?" * 500 + "c" * 500, "d" * 12, "?" * 19 + " e" * 60, "", " " * 30 + "f g" * 200]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    name = lambda t: text.strip(F.replace(t, F.lit("?")))
    got = df.select("t", text._begin(F.col("t"), name, 10).alias("n"))
    assert {r.t: r.n for r in got.collect()} == {t: t.replace("?", "").strip()[:10] for t in texts}
    # each beginning is named once in the plan
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("1, 20)") == plan.count("1, 80)") == 1
