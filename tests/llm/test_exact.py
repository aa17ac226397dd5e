"""Exact search, vector codes and phrases against brute force, and on awkward rows."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from caselake.llm import exact_search, phrases, vector_codes

VECTORS = "vec_id bigint, embedding array<double>, label int"


def brute_top(queries, rows, k):
    """Plainly, in Python's integers."""
    ints = lambda v: [math.floor(256 * x) if abs(x) < 2**50 else 256 * int(x) for x in v]
    cut = lambda x: min(max(x, -(2**63)), 2**63 - 1)
    fine = lambda r: r[0] is not None and r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])
    asked = {}
    for i, v in (r[:2] for r in queries if fine(r)):
        asked[i] = min(v, asked.get(i, v))
    out = []
    for i, v in asked.items():
        a = [cut(x) for x in ints(v)]
        found = sorted((-cut(sum(x * cut(y) for x, y in zip(a, ints(w)))), j) for j, w in (r[:2] for r in rows if fine(r)) if j != i and len(w) == len(v))
        out += [(i, n, j, -s) for n, (s, j) in enumerate(found[:k], 1)]
    return sorted(out)


def vectors(seed, n=300, width=8):
    rng = np.random.default_rng(seed)
    rows = [(i, [float(x) for x in rng.normal(size=width)], int(rng.integers(0, 4))) for i in range(n)]
    for i in range(n // 8, n // 4):  # many equal ones
        rows[i] = (i, rows[n // 8][1], None)
    return rows


def awkward():
    nan, inf = float("nan"), float("inf")
    return [
        (300, None, 1), (350, [1.0, None], 1), (400, [nan] * 8, 1), (450, [inf] * 8, 1), (None, [1.0] * 8, 1), (500, [], None), (501, [], 2), (550, [0.0] * 8, 1),
        (600, [1.0, 2.0], 1), (601, [2.0, -2.0], 1), (650, [1e30] * 8, 1), (651, [-1e300] * 8, 1), (652, [3e10, -3e10] * 4, 2), (50, [0.5] * 8, 1), (50, [0.25] * 8, 1), (7, [9.0] * 8, 1), (7, [9.0] * 8, 1),
    ]


@pytest.mark.parametrize("sizes", [(4096, 2048, 32_768, 64), (16, 2, 20, 3), (1, 1, 1, 2)])
def test_exact_search_equals_brute_force(spark, monkeypatch, sizes):
    for name, value in zip(("SHARD_ROWS", "BLOCK_ROWS", "GROUP_ROWS", "FAN"), sizes):
        monkeypatch.setattr(exact_search, name, value)
    n = 300 if sizes[0] > 1 else 30
    rows = vectors(1, n) + awkward()
    random.Random(2).shuffle(rows)
    df = spark.createDataFrame(rows, VECTORS).withColumn("n", F.lit("x")).withColumn("width", F.lit(1))
    got = exact_search.top_k(df.filter("vec_id % 50 = 0"), df.repartition(3), 5)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, got.collect())) == brute_top([r for r in rows if r[0] is not None and r[0] % 50 == 0], rows, 5)


def test_exact_search_with_few_or_no_rows(spark):
    rows = [(0, [1.0], 1), (1, [2.0], 1)]
    df = spark.createDataFrame(rows, VECTORS)
    assert [tuple(r) for r in exact_search.top_k(df.filter("vec_id = 0"), df).collect()] == [(0, 1, 1, 256 * 512)]
    assert exact_search.top_k(df.filter("vec_id = 9"), df).count() == 0
    assert exact_search.top_k(df, df.limit(0)).count() == 0


def test_products_and_floors_at_the_ends_of_the_range():
    big = np.array([[2**62, -(2**62)], [3, 5]], np.int64)
    assert exact_search.products(big, big).tolist() == [[2**63 - 1, -(2**63)], [-(2**63), 34]]
    assert exact_search.scaled(np.array([1e308, -1e308, -0.001, 0.0])).tolist() == [2**63 - 1, -(2**63), -1, 0]
    score = np.array([[5, -(2**63), 2**63 - 1, 5]], np.int64)
    assert exact_search.best(score, np.array([[True, True, True, False]]), 3).tolist() == [[2, 0, 1]]


# ---- codes of vectors ----


def brute_codes(rows, parts, entries, rounds):
    """Plainly, in Python's integers: rows of vec_id, code, error and label_error, and the codebooks' digest."""
    fine = [r for r in rows if r[1] and all(x is not None and math.isfinite(x) for x in r[1])]
    widths = [len(r[1]) for r in fine]
    width = min(set(widths), key=lambda w: (-widths.count(w), w))
    fine = sorted((r for r in fine if len(r[1]) == width), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    ints = [[min(max(math.floor(256 * x) if abs(x) < 2**50 else 256 * int(x), -(2**63)), 2**63 - 1) for x in r[1]] for r in fine]
    step = -(-width // parts)
    cut = [[v[p * step : (p + 1) * step] for p in range(parts)] for v in ints]
    books = [[list(v[p]) for v in cut[:entries]] for p in range(parts)]

    def near(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), n) for n, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            codes = [near(v[p], books[p])[1] for v in cut]
            for n in set(codes):
                own = [v[p] for v, c in zip(cut, codes) if c == n]
                books[p][n] = [sum(x) // len(own) for x in zip(*own)]
    found = [[near(v[p], books[p]) for p in range(parts)] for v in cut]
    errors = [sum(d for d, _ in f) for f in found]
    cap = lambda x: min(x, 2**63 - 1)
    by_label = {r[2]: sum(cap(e) for e, s in zip(errors, fine) if s[2] == r[2]) for r in fine}
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(((-1 if r[0] is None else r[0]), bytes(n for _, n in f).hex(), cap(e), cap(by_label[r[2]]), digest) for r, f, e in zip(fine, found, errors))


@pytest.mark.parametrize("case", ["plain", "uneven", "few", "huge"])
def test_codes_equal_brute_force(spark, case):
    width, parts, entries = {"plain": (8, 4, 16), "uneven": (7, 4, 5), "few": (6, 16, 64), "huge": (8, 2, 20)}[case]
    rows = vectors(5, 12 if case == "few" else 200, width) + [(9, [0.5] * width, None), (None, [0.25] * width, 3), (9, [0.5] * width, None)] + [r for r in awkward() if r[1] != [0.5] * 8]
    if case != "huge":
        rows = [r for r in rows if not r[1] or all(x is None or not math.isfinite(x) or abs(x) < 1e6 for x in r[1])]
    random.Random(3).shuffle(rows)
    df = spark.createDataFrame(rows, VECTORS).withColumn("code", F.lit("x")).withColumn("_label", F.lit(1)).repartition(3)
    got = vector_codes.compress(df, parts=parts, entries=entries).fillna({"vec_id": -1})
    assert sorted((r.vec_id, bytes(r.code).hex(), r.error, r.label_error, r.codebooks_sha256) for r in got.collect()) == brute_codes(rows, parts, entries, 2)


def test_codes_of_no_vectors(spark):
    df = spark.createDataFrame(awkward()[:5], VECTORS).filter("vec_id IS NOT NULL")
    assert vector_codes.compress(df).count() == 0 and vector_codes.compress(df.limit(0)).count() == 0


def test_partial_distances_find_the_nearest():
    rng = np.random.default_rng(8)
    for spread in (2, 50, 2**40):
        book, v = rng.integers(-spread, spread, (37, 5)), rng.integers(-spread, spread, (500, 5))
        gap = v[:, None].astype(object) - book[None].astype(object)
        full = (gap * gap).sum(2)
        code, best = vector_codes.Codebook(book).nearest(v)
        assert code.tolist() == [min(range(37), key=lambda e: (f[e], e)) for f in full] and [int(b) for b in best] == [min(f) for f in full]


# ---- phrases ----

DOCS = "lang string, text string"


def brute_phrases(rows, least, longest, most):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                f.update((lang, tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    out = {}
    for (lang, p), a in f.items():
        if len(p) < 2 or a < least:
            continue
        if any(g == lang and len(q) > len(p) and 100 * b >= 100 * a and any(q[i : i + len(p)] == p for i in range(len(q))) for (g, q), b in f.items() if b >= least):
            continue
        cuts = [(1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]], n[lang]))
    return sorted((lang, i, p.decode(), -a, x, y, m, -s) for lang, found in out.items() for i, (s, a, p, x, y, m) in enumerate(sorted(found)[:most], 1))


def prose(seed, n=60):
    rng = random.Random(seed)
    common = ["the", "of", "É", "été", "court", "THE", "x-y", "a\x00b", "　", "naïve"]
    passage = "By Order of the court it is so ordered"
    rows = [(None, None), ("en", ""), ("en", " \t\n"), (None, "the of the of"), ("und", "The OF the"), ("", "the of the"), ("en", "a a a a a a a")]
    for i in range(n):
        words = [rng.choice(common) for _ in range(rng.randint(0, 60))]
        if i % 3 == 0:
            words.insert(rng.randint(0, len(words)), passage)
        rows.append((rng.choice(["en", "fr", None]), "".join(w + rng.choice([" ", "  ", "\t", " ", " ", ". ", ",", "\n", "\x0b"]) for w in words)))
    return rows + [rows[-1]] * 2


@pytest.mark.parametrize("sizes", [(1 << 20, 1 << 20, 1 << 26), (64, 3, 1 << 10)])
def test_phrases_equal_brute_force(spark, monkeypatch, sizes):
    for name, value in zip(("TEXT_BYTES", "MOST_HASHES", "BITMAP_BITS"), sizes):
        monkeypatch.setattr(phrases, name, value)
    rows = prose(4)
    df = spark.createDataFrame(rows, DOCS).withColumn("phrase", F.lit("x")).withColumn("f", F.lit(1)).repartition(3)
    for least, longest, most in ((4, 5, 2000), (9, 3, 7)):
        got = phrases.collocations(df, least, longest, most)
        assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
        assert sorted(map(tuple, got.collect())) == brute_phrases(rows, least, longest, most)


def test_phrases_of_a_long_text_and_of_nothing(spark):
    rng = random.Random(6)
    text = " ".join(rng.choice(["one", "two", "three.", "f" * 9000]) for _ in range(3000)) + " \t" * 5000 + "one two"
    rows = [("en", text * 2), ("en", "w" * 3_000_000), ("en", "one two")]
    df = spark.createDataFrame(rows, DOCS)
    got = sorted(map(tuple, phrases.collocations(df, 20, 5).collect()))
    assert got == brute_phrases(rows, 20, 5, 2000) and len(got) > 20
    assert phrases.collocations(df.limit(0)).count() == 0 and phrases.collocations(df, 10**6).count() == 0


@pytest.mark.parametrize("k", [1, 2, 3, 5])
def test_parts_of_a_long_text_hold_each_run_of_words_once(monkeypatch, k):
    rng = random.Random(k)
    for size in (1, 7, 50, 5000):
        monkeypatch.setattr(phrases, "TEXT_BYTES", size)
        text = "".join(rng.choice("ab é.\t") for _ in range(4000))
        runs = lambda t: Counter(tuple(w) for w in zip(*[re.findall(r"[^ .\t]+", t)[j:] for j in range(k)]))
        assert sum((runs(p.decode()) for p in phrases._pieces(text, k)), Counter()) == runs(text)
