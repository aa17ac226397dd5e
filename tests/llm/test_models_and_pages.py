"""Models, pages, conversations and vectors: held-out accuracy, brute force, awkward rows."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from caselake.llm import ann
from caselake.llm.ann import Index, _classes, fit_index, search, valid_vectors
from caselake.llm.main_text import _blocks, _events, _match, _tree, extract_main_text, induce
from caselake.llm.mixing import mix_to_targets
from caselake.llm.preference import format_preferences, swapped_answers
from caselake.llm.secrets import find_secrets, fit_secrets, mask_secrets
from caselake.llm.toxicity import drop_toxic, fit_toxicity, score_toxicity
from caselake.llm.url_filter import fit_urls, judge_by_rules, judge_urls

DOCS = "doc_id bigint, text string"


# ---- toxicity ----


def toxic_corpus(n, seed):
    """Toxic only where an insult and a group stand together, so no single word decides."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        w = [f"w{rng.randrange(300)}" for _ in range(rng.randint(5, 40))]
        insult, group = rng.random() < 0.5, rng.random() < 0.5
        w += ["dreadful"] * insult + ["martians"] * group
        rng.shuffle(w)
        rows.append((i, " ".join(w), int(insult and group)))
    return rows


def test_pairs_of_terms_are_learnt(spark):
    rows = toxic_corpus(1500, 1)
    df = spark.createDataFrame(rows, DOCS + ", toxic int")
    machine = fit_toxicity(df.select("doc_id", "text"), df.filter("doc_id % 3 <> 1").select("doc_id", "toxic"))
    held = score_toxicity(df.filter("doc_id % 3 = 1"), machine).collect()
    assert np.mean([r.is_toxic == bool(r.toxic) for r in held]) > 0.97
    assert all(0 <= r.toxicity <= 1 for r in held)


def test_toxicity_of_awkward_rows(spark):
    df = spark.createDataFrame([(None, None, 1.5), (1, "", 2.5), (1, "x " * 50_000, 3.5)], DOCS + ", toxicity double")
    none = spark.createDataFrame([(None, 1), (1, None)], "doc_id bigint, toxic int")
    machine = fit_toxicity(df.select("doc_id", "text"), none)
    assert [r.toxicity for r in score_toxicity(df, machine).collect()] == [0.5, 0.5, 0.5]
    assert sorted(r.toxicity for r in drop_toxic(df, machine).collect()) == [1.5, 2.5, 3.5]
    assert score_toxicity(df.limit(0), machine).count() == 0


# ---- secrets ----

ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)


def pattern_spans(text):
    text = text or ""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(out)


def secret_corpus(n, seed):
    rng = random.Random(seed)
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    pick = lambda k, s=letters: "".join(rng.choice(s) for _ in range(k))
    rows = []
    for i in range(n):
        lines = [" ".join(rng.choice(["the", "été", "of", "fade", "a1", "Über"]) for _ in range(rng.randint(1, 12))) for _ in range(rng.randint(1, 6))]
        extra = rng.choice(["", f'token = "{pick(24)}"', f"Password:{pick(11)}", f"API_KEY={pick(30)}", "AKIA" + pick(16, "ABC123"), "AKIA12", pick(40, "0123456789abcdef"), "x" + pick(15, "0123456789abcdef"), f"bearer {pick(32)}", f"secret='{pick(14)}', passwd: {pick(20)}"])
        lines.insert(rng.randrange(len(lines) + 1), "é " + extra)
        rows.append((i, "\n".join(lines)))
    return [*rows, (n, None), (n + 1, ""), (None, "token=abcdefabcdef0123"), (n + 2, "password = \npasswordtoken:aaaaaaaaaaaaa")]


def test_base_spans_equal_the_patterns(spark):
    rows = secret_corpus(300, 4)
    df = spark.createDataFrame([(*r, "s") for r in rows], DOCS + ", secrets string")
    field = fit_secrets(df.select("doc_id", "text"))
    got = find_secrets(df, field).collect()
    kinds = ("assign", "access", "hex")
    for (i, text), r in zip(rows, got):
        assert r.doc_id == i
        assert [(x.start, kinds.index(x.kind), x.end) for x in r.secrets if x.kind != "crf"] == pattern_spans(text), text
        base = pattern_spans(text)
        for x in r.secrets:
            if x.kind == "crf":
                assert not any(a < x.end and x.start < b for a, _, b in base)
    again = fit_secrets(df.select("doc_id", "text"))
    assert (again.emit == field.emit).all() and (again.move == field.move).all()
    masked = mask_secrets(df, field).collect()
    assert [r.secrets for r in masked] == ["s"] * len(rows)
    for (_, text), r, f in zip(rows, masked, got):
        assert (r.text is None) == (text is None)
        for x in f.secrets:
            assert text[x.start : x.end] not in (r.text or "")
        if not f.secrets:
            assert r.text == text


def test_the_field_finds_what_no_pattern_names(spark):
    """Trained on named secrets, it tags the same shapes behind a word that no pattern knows."""
    rng = random.Random(8)
    value = lambda: "".join(rng.choice("abcdefghijkmnpqrstuvwxyzABCDEFGHJKLMNPQRSTUVWXYZ23456789") for _ in range(28))
    rows = [(i, f"some words before token = {value()} and after" if i % 2 else "some words and some more words after") for i in range(400)]
    field = fit_secrets(spark.createDataFrame(rows, DOCS))
    unseen = [(i, f"some words before bearer = {value()} and after") for i in range(40)]
    found = find_secrets(spark.createDataFrame(unseen, DOCS), field).collect()
    hit = [any(x.kind == "crf" and len(r.text[x.start : x.end]) == 28 for x in r.secrets) for r in found]
    assert np.mean(hit) > 0.9
    plain = find_secrets(spark.createDataFrame([(1, "some words before and after"), (2, None)], DOCS), field).collect()
    assert [r.secrets for r in plain] == [[], []]


def test_no_documents_no_secrets(spark):
    empty = spark.createDataFrame([], DOCS)
    assert find_secrets(empty, fit_secrets(empty)).count() == 0


# ---- mixing ----


def test_rates_meet_the_targets(spark):
    rng = random.Random(5)
    kinds = {"a": ["ant", "ape"], "b": ["bee", "bat"]}
    rows = []
    for i in range(600):
        d = "a" if rng.random() < 0.8 else "b"
        rows.append((i, " ".join(rng.choice(kinds[d] + ["the", "of", "and"]) for _ in range(rng.randint(5, 60))), d))
    df = spark.createDataFrame(rows, DOCS + ", domain string").withColumn("rate", F.lit("old"))
    labelled = df.filter("doc_id % 2 = 0").select("doc_id", "domain")
    out = mix_to_targets(df, labelled, {"a": 0.4, "b": 0.6}).collect()
    total = sum(r.n_tokens for r in out)
    for d, goal in (("a", 0.4), ("b", 0.6)):
        assert abs(sum(r.n_tokens * r.rate * r[f"p_{d}"] for r in out) / total - goal) < 2e-3
    assert np.mean([(r.p_a > 0.5) == (r.domain == "a") for r in out if r.doc_id % 2]) > 0.95
    assert all(r.rate >= 0 and abs(r.copies - r.rate) < 1 for r in out) and len(out) == 600


def test_rates_equal_a_plain_projected_gradient(spark):
    rows = [(i, " ".join(["ant" if i % 3 else "bee"] * (i + 1))) for i in range(20)]
    df = spark.createDataFrame(rows, DOCS)
    labelled = df.select("doc_id", F.when(F.col("doc_id") % 3 != 0, "a").otherwise("b").alias("domain"))
    out = mix_to_targets(df, labelled, {"a": 0.3, "b": 0.7}, steps=11, tolerance=0.0).orderBy("doc_id").collect()
    p, t = np.array([[r.p_a, r.p_b] for r in out]), np.array([r.n_tokens for r in out], float)
    metric = np.linalg.inv((p * t[:, None]).T @ p / t.sum() + 1e-6 * np.eye(2))
    rate = np.ones(20)
    for _ in range(11):
        off = (t * rate) @ p / t.sum() - np.array([0.3, 0.7])
        rate = np.maximum(0, rate - (p @ (metric @ off) + 1e-3 * (rate - 1)) / 1.001)
    assert np.allclose(rate, [r.rate for r in out], atol=1e-6)


def test_mixing_of_awkward_rows(spark):
    df = spark.createDataFrame([(None, None), (1, ""), (1, "")], DOCS)
    labelled = spark.createDataFrame([(None, "a"), (1, None), (1, "z")], "doc_id bigint, domain string")
    out = mix_to_targets(df, labelled, {"a": 1.0, "b": 1.0}).collect()
    assert [(r.n_tokens, r.rate) for r in out] == [(0, 1.0)] * 3
    assert mix_to_targets(df.limit(0), labelled, {"a": 1.0, "b": 1.0}).count() == 0


# ---- urls ----


def test_rules(spark):
    urls = ["http://X.example.COM/en/9", "http://example.com/en/7x", "ftp://a.net/de/1?x#y", "http://example.net/de/8", "http://example.net/de/9", "org/es/", "http://org/es/", "http://myorg/es/", None, "", "http://a.example.com?x=/en/", "http://com/en/://x"]
    got = [(r.host, r.path, r.rule, r.rule_verdict) for r in judge_by_rules(spark.createDataFrame([(u,) for u in urls], "url string")).collect()]
    assert got == [
        ("x.example.com", "/en/9", "com/en/", "block"), ("example.com", "/en/7x", "example.com/en/7", "allow"), ("a.net", "/de/1", "net/de/", "allow"), ("example.net", "/de/8", "example.net/de/8", "block"),
        ("example.net", "/de/9", "net/de/", "allow"), ("", "", None, None), ("org", "/es/", "org/es/", "block"), ("myorg", "/es/", None, None), ("", "", None, None), ("", "", None, None), ("a.example.com", "", None, None), ("com", "/en/://x", "com/en/", "block"),
    ]


def test_trees_generalise(spark):
    rng = random.Random(2)
    rows = []
    for i in range(900):
        bad = rng.random() < 0.5
        host = f"{'x' + str(rng.randrange(10**6)) if bad else rng.choice(['news', 'blog', 'docs'])}.{rng.choice(['example', 'sample'])}.{'biz' if bad and rng.random() < 0.7 else 'com'}"
        path = "/" + "/".join((str(rng.randrange(10**8)) if bad else rng.choice(["a", "about", "post"])) for _ in range(rng.randint(1, 4)))
        rows.append((f"http://{host}{path}", int(bad)))
    df = judge_by_rules(spark.createDataFrame(rows, "url string, blocked int"), ()).drop("rule", "rule_verdict").withColumn("n", F.monotonically_increasing_id())
    model = fit_urls(df.filter("n % 2 = 0"))
    held = judge_urls(df.filter("n % 2 = 1"), model, ()).collect()
    assert np.mean([(r.verdict == "block") == bool(r.blocked) for r in held]) > 0.97
    odd = spark.createDataFrame([(None, "v", 1), ("", "v", 2), ("h" * 5000, "v", 3)], "url string, verdict string, page_id int")
    assert [r.verdict in ("allow", "block") for r in judge_urls(odd, model).collect()] == [True] * 3


def test_suffixes_of_all_labelled_urls_count(spark):
    rows = [(f"http://h{i}.example.com/{j}", i % 2) for i in range(2100) for j in range(2)]
    df = judge_by_rules(spark.createDataFrame(rows, "url string, blocked int"), ())
    model = fit_urls(df, max_rows=400, trees=2)
    assert [s.count() for s in model.suffixes] == [1, 1, 2100]
    assert model.suffixes[2].select(F.countDistinct("_share2"), F.min("_seen2"), F.max("_seen2")).first()[:] == (2, np.log2(3), np.log2(3))


def test_urls_of_one_class(spark):
    one = judge_by_rules(spark.createDataFrame([("http://a/b", 0)], "url string, blocked int"))
    assert [r.verdict for r in judge_urls(one.select("url"), fit_urls(one)).collect()] == ["allow"]
    assert judge_urls(one.select("url").limit(0), fit_urls(one.limit(0))).count() == 0


# ---- pages ----

PAGE = """<!doctype html><html><head><title>T</title><style>p{{}}</style><script>if(a<b)"</p>"</script></head><body>
<header><a href="/">Site</a></header><nav><ul><li>Menu {n}<li>Other</ul></nav>
<div class="cookie-notice">We use cookies {n}</div><div class="tagline">Always the same words</div>
<article><h1>Title {n}</h1><p>First &amp; <b>bold {n}<br>line<p>Second&nbsp;{n}<div class="share">Share</div><form>Name <input></form><ul><li>one {n}<li>two</ul></article>
<aside>Side {n}</aside><section id="comments"><p>Reader {n}</p></section><footer>&copy; {n}</footer></body></html>"""


def test_articles_without_the_rest(spark):
    pages = [(i, f"http://h.example/{i}", PAGE.format(n=f"n{i}"), "old") for i in range(12)]
    df = spark.createDataFrame(pages, "page_id bigint, url string, html string, text string")
    for r in extract_main_text(df).collect():
        n = f"n{r.page_id}"
        assert r.text == f"Title {n}\n\nFirst & bold {n} line\n\nSecond {n}\n\none {n}\n\ntwo"


def test_wrapper_finds_container_and_constants():
    plain = "<body><div class=top><div>Constant line</div></div><div class=content><h2>T{n}</h2><p>Words {n} and more words of this page {n}</p><p>Fixed words</p></div><div class=bottom>Same end</div></body>"
    wrapper = induce([plain.format(n=i) for i in range(8)])
    assert wrapper["container"][-1] == "div.content"
    assert sorted(t for _, t in wrapper["constants"]) == ["Constant line", "Fixed words", "Same end"]
    size, pairs = _match(_tree(plain.format(n=1)), _tree(plain.format(n=2)))
    assert size == len(pairs) == 9


@pytest.mark.parametrize("page", ["", "<", "<p", "a < b > c", "<div a='x>y'>t</div>", "<!-- open", "<script>x", "</p></div>t", "<p>" * 300 + "x", "<b>" * 200 + "y", "&amp;&#65;&nosuch;", "<a href='q>z"])
def test_broken_pages_are_read(page):
    opened = 0
    for kind, _, _ in _events(page):
        opened += {"open": 1, "close": -1, "text": 0}[kind]
        assert opened >= 0
    assert opened == 0
    list(_blocks(page))


def test_awkward_pages(spark):
    long = "<article>" + "".join(f"<p>para {i}</p>" for i in range(5000)) + "</article>"
    rows = [(1, None, None), (2, "http://a/", ""), (3, "http://a/", long), (3, "http://a/", long), (4, "", "text only"), (None, "http://b/", "<p>x")]
    got = {(r.page_id, r.text) for r in extract_main_text(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert got == {(1, ""), (2, ""), (3, "\n\n".join(f"para {i}" for i in range(5000))), (4, "text only"), (None, "x")}
    assert extract_main_text(spark.createDataFrame([], "page_id bigint, url string, html string")).count() == 0


def main_texts(spark, htmls):
    df = spark.createDataFrame([(i, f"http://h.example/{i}", h) for i, h in enumerate(htmls)], "page_id bigint, url string, html string")
    return {r.page_id: r.text for r in extract_main_text(df).collect()}


def test_text_outside_a_container_is_kept(spark):
    long = "body words " * 200
    news = "<article><h1>Head {n}</h1><div class=lead>Lead {n}</div><div class=body>" + long + "{n}</div></article>"
    short = "<div class=page><div class=body>Snippet {n}</div></div><div class=story><p>Story {n} " + long + "</p></div>"
    plain = "<div class=page><div class=body>" + long + "{n}</div></div>"
    assert main_texts(spark, [news.format(n=i) for i in range(9)]) == {i: f"Head {i}\n\nLead {i}\n\n{long}{i}" for i in range(9)}
    got = main_texts(spark, [(short if i == 8 else plain).format(n=i) for i in range(9)])
    assert got == {i: f"{long}{i}" for i in range(8)} | {8: f"Snippet 8\n\nStory 8 {long.strip()}"}


def test_template_after_many_children():
    pages = ["<body>" + "".join(f"<p>text {n} {i}</p>" for i in range(70 + n)) + "<p>Same <b>end</b></p><p>Varies {n}</p></body>".format(n=n) for n in range(8)]
    assert induce(pages)["constants"] == [[["body", "p"], "Same end"]]


def brute_match(a, b):
    if a.sign != b.sign:
        return 0
    best = [[0] * (len(b.children) + 1) for _ in range(len(a.children) + 1)]
    for i, u in enumerate(a.children):
        for j, v in enumerate(b.children):
            best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], best[i][j] + brute_match(u, v))
    return best[-1][-1] + 1


def test_matches_are_largest():
    rng = random.Random(4)

    def some(depth):
        tag = rng.choice(["div", "section", "p"]) if depth else "p"
        return f"<{tag}>{rng.choice('ab')}{''.join(some(depth - 1) for _ in range(rng.randint(0, 4))) if tag != 'p' else ''}</{tag}>"

    for _ in range(60):
        a, b = (_tree("".join(some(3) for _ in range(4))) for _ in range(2))
        size, pairs = _match(a, b)
        assert size == len(pairs) == len({id(u) for u, _ in pairs}) == len({id(v) for _, v in pairs}) == brute_match(a, b)


def test_template_of_small_hosts_and_of_layouts(spark):
    page = "<html><body><div class=top>{notice}</div><div class={kind}>" + "<p>Words {n} of this page</p>" + "<p>{a}</p><p>{b}</p></div><div>Same <i>end</i></div></body></html>"
    copy = "<html><head><meta name=id content={n}></head><body><div>One story</div></body></html>"
    rows, want = [], {}

    def add(host, html, text):
        want[len(rows)] = text
        rows.append((len(rows), f"http://{host}/{len(rows)}", html))

    for size in (2, 3, 5):
        for n in range(size):
            add(f"small{size}", page.format(notice="Notice", kind="c", n=n, a=f"a{n}", b=f"b{n}"), f"Words {n} of this page\n\na{n}\n\nb{n}")
    for n in range(40):  # layouts of 25, 12 and 3 pages
        kind = "c" if n < 25 else "d" if n < 37 else "e"
        add("large", page.format(notice=f"Notice {kind}", kind=kind, n=n, a=f"a{n}", b=f"b{n}"), f"Words {n} of this page\n\na{n}\n\nb{n}")
    for n in range(2):
        add("copies", copy.format(n=n), "One story")
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    assert {r.page_id: r.text for r in extract_main_text(df).collect()} == want


# ---- conversations ----

TURNS = "pair_id bigint, turn bigint, role string, text string"


def test_preferences(spark):
    a = spark.createDataFrame([(1, 0, "user", "q"), (1, 1, "assistant", "good"), (1, 2, "user", "more"), (2, 0, "user", "only"), (None, 0, "user", "x"), (3, 1, None, None), (3, 0, "user", "z")], TURNS)
    b = spark.createDataFrame([(1, 0, "user", "q"), (1, 1, "assistant", "bad"), (3, 0, "user", "z"), (3, 1, None, None), (4, 0, "assistant", "alone")], TURNS)
    got = {r.pair_id: r for r in format_preferences(a, b).collect()}
    t = lambda role, text: f"<|im_start|>{role}\n{text}<|im_end|>\n"
    assert got[1].prompt == t("user", "q") and got[1].n_prompt_turns == 1
    assert got[1].chosen == t("assistant", "good") + t("user", "more") and got[1].rejected == t("assistant", "bad")
    assert [(s.text, s.loss) for s in got[1].chosen_segments] == [("<|im_start|>assistant\n", 0), ("good<|im_end|>\n", 1), ("<|im_start|>user\n", 0), ("more<|im_end|>\n", 0)]
    assert (got[2].prompt, got[2].chosen, got[2].rejected) == ("", t("user", "only"), "")
    assert got[3].prompt == t("user", "z") + t("", "") and got[3].chosen == got[3].rejected == ""
    assert got[4].chosen == "" and got[4].rejected == t("assistant", "alone") and None not in got
    assert format_preferences(a.limit(0), b.limit(0)).count() == 0


def test_swapped_answers(spark):
    turns = spark.createDataFrame([(2, 0, "user", "q"), (2, 1, "assistant", "A"), (2, 2, "user", "bye"), (3, 0, "user", "r"), (3, 1, "assistant", "B"), (4, 0, "user", "s")], "conv_id bigint, turn bigint, role string, text string")
    got = sorted((r.pair_id, r.turn, r.text) for r in swapped_answers(turns).collect())
    last = (1 << 63) - 1
    assert got == [(2, 0, "q"), (2, last, "B"), (3, 0, "r"), (3, last, "A"), (4, 0, "s")]


def test_preferences_with_nulls_equal_the_sql(spark, tmp_path):
    import duckdb

    from caselake.llm.preference import OP1_SQL, op1_preference

    rows = [(2, None, "user", "early"), (2, 0, "user", None), (2, 1, "assistant", "A"), (3, 0, None, "r"), (3, 1, "assistant", None), (3, 1, "assistant", "B"), (4, 0, "user", "s"), (None, 0, "user", "x"), (5, 7, "assistant", "")]
    spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").coalesce(1).write.parquet(f"{tmp_path}/conversations.parquet")
    got = op1_preference(spark, str(tmp_path))
    want = duckdb.connect().execute(f"WITH conversations AS (SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'), {OP1_SQL.strip().removeprefix('WITH ')}")
    columns = [c[0] for c in want.description]
    assert sorted(map(tuple, got.select(*columns).collect())) == sorted(want.fetchall())


# ---- vectors ----


def nearest(rows, queries, k):
    x = {i: np.array(v, float) for i, v in rows}
    out = {}
    for q in queries:
        scores = sorted(((-float(sum(a * b for a, b in zip(x[q], v))), i) for i, v in x.items() if i != q))[:k]
        out[q] = [(i, -s) for s, i in scores]
    return out


def test_recall_and_exact_scores(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=24).astype(np.float32).tolist()) for i in range(3000)]
    rows += [(3000 + i, rows[7][1]) for i in range(900)]  # a vector that is very common
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    got = {}
    for r in search(df.filter("vec_id % 100 = 0"), df).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    want = nearest(rows, [i for i, _ in rows if i % 100 == 0], 20)
    hit = total = 0
    assert got.keys() == want.keys()
    for q, w in want.items():
        found = sorted(got[q])
        assert [x[0] for x in found] == list(range(1, 21))
        assert [(-s, v) for _, v, s in found] == sorted((-s, v) for _, v, s in found)
        exact = dict(w)
        assert all(abs(s - exact[v]) < 1e-12 for _, v, s in found if v in exact)
        hit += len({v for _, v, _ in found} & exact.keys())
        total += 20
    assert hit / total >= 0.9


def test_a_common_vector_takes_one_place(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(2000, 64))
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(2000 + i, x[7].tolist()) for i in range(1000)]
    scores = x @ x.T
    np.fill_diagonal(scores, -np.inf)
    before = (scores > scores[:, 7:8]).sum(1)  # how many vectors are nearer than the common one
    near = [int(i) for i in np.flatnonzero((before >= 5) & (before <= 60))]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    asked = df.filter(F.col("vec_id").isin(near))
    found = [(r.query_id, r.vec_id) for r in search(asked, df, probes=1.0).collect()]
    want = nearest(rows, near, 20)
    hit = [len({v for q, v in found if q == i} & {v for v, _ in want[i]}) for i in near]
    assert len(near) >= 20 and len(found) == 20 * len(near) and sum(hit) >= 0.99 * 20 * len(near)


def test_ids_that_repeat(spark):
    rows = [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (2, [1.0, 0.0]), (2, [0.5, 0.0]), (3, [0.5, 0.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in search(df.filter("vec_id = 1"), df, k=4).collect())
    assert got == [(1, 1, 2, 1.0), (1, 2, 2, 1.0), (1, 3, 2, 0.5), (1, 4, 3, 0.5)]


def test_awkward_vectors(spark):
    rows = [(1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, None), (4, [float("nan"), 1.0]), (5, [1.0, None]), (6, [float("inf"), 1.0]), (7, [2.0, 1.0]), (8, []), (None, [1.0, 1.0]), (9, [2.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumn("rank", F.lit(0))
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in search(df, df, k=2).collect())
    assert got == [(1, 1, 7, 2.0), (1, 2, 9, 2.0), (7, 1, 9, 5.0), (7, 2, 1, 2.0), (9, 1, 7, 5.0), (9, 2, 1, 2.0)]
    assert search(df.limit(0), df).count() == 0 and search(df, df.limit(0)).count() == 0


def test_vectors_of_another_width_take_no_part(spark):
    rows = [(1, [1.0, 0.0]), (2, [2.0, 1.0]), (3, [1.0]), (4, [3.0, 1.0, 1.0]), (5, [0.5, 0.5])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = sorted((r.query_id, r.rank, r.vec_id) for r in search(df, df, k=5).collect())
    assert got == [(1, 1, 2), (1, 2, 5), (2, 1, 1), (2, 2, 5), (5, 1, 2), (5, 2, 1)]


def test_clustered_vectors_need_few_cells(spark):
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(60, 16)) * 6
    x = centres[rng.integers(0, 60, 3000)] + rng.normal(size=(3000, 16))
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    index = fit_index(_classes(valid_vectors(df), 20), 3000)
    assert index.probes(20, 0.95) <= len(index.centres) // 3
    queries = [i for i in range(0, 3000, 50)]
    scores = x[queries] @ x.T
    scores[np.arange(len(queries)), queries] = -np.inf
    want = np.argsort(-scores, axis=1)[:, :20]
    found = {}
    for r in search(df.filter("vec_id % 50 = 0"), df).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    assert np.mean([len(found[q] & set(w.tolist())) / 20 for q, w in zip(queries, want)]) >= 0.9


def test_queries_unlike_the_other_vectors_find_their_nearest(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(321, 32))[rng.permutation(8000) // 25] + rng.normal(size=(8000, 32)) * 0.01
    queries = np.arange(0, 8000, 40)
    x[queries] = rng.normal(size=(200, 32))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>")
    scores = x[queries] @ x.T
    scores[np.arange(len(queries)), queries] = -np.inf
    want = np.argsort(-scores, axis=1)[:, :20]
    found = {}
    for r in search(df.filter("vec_id % 40 = 0"), df).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    assert np.mean([len(found[q] & set(w.tolist())) / 20 for q, w in zip(queries.tolist(), want)]) >= 0.9


def test_shards_are_of_bounded_size(monkeypatch):
    monkeypatch.setattr(ann, "BLOCK_ROWS", 8192)
    index = Index(np.zeros((6, 2)), [np.zeros((1, 2))], np.zeros(1), np.zeros((1, 2)), 0.0)
    index.pack(np.array([5000, 3000, 3000, 20_000, 0, 10]))
    assert index.shard.tolist() == [0, 0, 1, 2, 5, 5] and index.n_shards.tolist() == [1, 1, 1, 3, 1, 1]
