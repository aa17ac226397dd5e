"""Scores of the fitted models against plain recomputations."""

import math
import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from caselake.llm import mixing, toxicity
from caselake.llm.toxicity import BINS, BITS, Machine, _ratio, fit_toxicity, score_toxicity
from caselake.llm.url_filter import URL_RULES_SQL, fit_urls, judge_by_rules, judge_urls, url_rules
from caselake.llm.words import LETTERS, Words

DOCS = "doc_id bigint, text string"


def plain_terms(text):
    """The bins of a text: its words, and the beginnings of those that are longer."""
    out = set()
    for word in "".join(c.lower() if c.isalnum() else " " for c in text).split():
        for part in [word, *(word[:k] for k in (3, 4, 5, 6) if len(word) > k)]:
            w = Words(pa.array([part if part == word else word]), lower=True, classes=LETTERS)
            h = w.hashes()[0] if part == word else next(hs[0] for k, (_, hs) in zip((3, 4, 5, 6), w.prefix_hashes((3, 4, 5, 6))) if k == len(part))
            out.add(int(h >> np.uint64(64 - BITS)))
    return out


def test_scores_are_those_of_the_formula(spark):
    rng = np.random.default_rng(2)
    texts = ["", "one two three", "Insulted insults INSULT! group group", "été " * 3, "x" * 5000]
    bins = np.array(sorted(set().union(*map(plain_terms, texts[1:4]))))
    machine = Machine(bins, -0.3, rng.normal(size=len(bins)), rng.normal(size=(len(bins), 4)))
    got = [r.toxicity for r in score_toxicity(spark.createDataFrame(list(enumerate(texts)), DOCS).coalesce(1), machine).collect()]
    for text, score in zip(texts, got):
        held = [int(np.flatnonzero(bins == b)[0]) for b in plain_terms(text) if b in bins]
        raw = machine.bias + sum(machine.weight[i] for i in held) + sum(float(machine.vector[i] @ machine.vector[j]) for i in held for j in held if i < j)
        assert abs(score - 1 / (1 + math.exp(-raw))) < 1e-9


def test_ratio_is_that_of_the_table(spark):
    def plain(toxic, docs, n1, n):
        cells = ((toxic, docs * n1 / n), (docs - toxic, docs * (n - n1) / n), (n1 - toxic, (n - docs) * n1 / n), (n - docs - n1 + toxic, (n - docs) * (n - n1) / n))
        return 2 * sum(o * math.log(o / e) for o, e in cells if o) if toxic / docs > n1 / n else 0.0

    rows = [(1, 1), (2, 2), (3, 30), (0, 5), (20, 100), (10, 10)]
    df = spark.createDataFrame(rows, "toxic bigint, docs bigint").coalesce(1)
    got = [r[0] for r in df.select(_ratio(F.col("toxic"), F.col("docs"), 20, 100)).collect()]
    assert np.allclose(got, [plain(t, d, 20, 100) for t, d in rows])


def test_training_rows_stay_within_their_bounds(spark):
    rng = random.Random(4)
    rows = [(i, f"{'bad' if i % 2 else 'good'} word{rng.randrange(9)} more", i % 2) for i in range(200)]
    df = spark.createDataFrame(rows, DOCS + ", toxic int")
    whole = fit_toxicity(df.select("doc_id", "text"), df.select("doc_id", "toxic"))
    assert len(whole.bins) and whole.weight[np.flatnonzero(whole.bins == next(iter(plain_terms("bad"))))[0]] > 0
    assert len(fit_toxicity(df.select("doc_id", "text"), df.select("doc_id", "toxic"), max_chars=10).bins) == 0
    assert (whole.bins < BINS).all() and toxicity.BINS == 1 << toxicity.BITS


# ---- mixing ----


def test_posteriors_are_those_of_a_plain_bayes(spark):
    rng = random.Random(6)
    vocabulary = {"a": ["ant", "ape", "asp"], "b": ["bee", "bat"], "c": ["cow"]}
    rows = []
    for i in range(400):
        d = rng.choice("abc")
        rows.append((i, " ".join(rng.choice(vocabulary[d] + ["the", "of"]) for _ in range(rng.randint(1, 20))), d))
    df = spark.createDataFrame(rows, DOCS + ", domain string").coalesce(1)
    told = {r.doc_id: set(r.bins) for r in mixing._told(df.select("doc_id", "text"), "n", "bins").collect()}
    test = {r.doc_id for r in df.filter("pmod(xxhash64(doc_id, 5), 5) = 0").collect()}
    names = ["a", "b", "c"]
    model = mixing.fit_domains(df.select("doc_id", "text"), df.select("doc_id", "domain"), names)
    train = [(told[i], d) for i, _, d in rows if i not in test]
    evidence = []
    for d in names:
        mine, others = [b for b, x in train if x == d], [b for b, x in train if x != d]
        weigh = {}
        for b in set().union(*told.values()):
            n, m = sum(b in x for x in mine), sum(b in x for x in others)
            if n + m:
                p, q = (n + 0.5) / (len(mine) + 1), (m + 0.5) / (len(others) + 1)
                table = np.array([[n, m], [len(mine) - n, len(others) - m]], float)
                expected = table.sum(1, keepdims=True) * table.sum(0, keepdims=True) / len(train)
                if 2 * (table * np.log(np.maximum(table, 1e-300) / expected)).sum() >= mixing.LEAST_RATIO:
                    weigh[b] = (math.log(p / q), math.log((1 - p) / (1 - q)))
        evidence.append({i: sum(w[0] if b in bins else w[1] for b, w in weigh.items()) for i, bins in told.items()})
    out = mixing.mix_to_targets(df, df.select("doc_id", "domain"), {"a": 1.0, "b": 1.0, "c": 1.0}).collect()
    prior = [(sum(x == d for _, x in train) + 1) / (len(train) + 3) for d in names]
    for r in out:
        score = [math.log(p) + e[r.doc_id] / model.temperature for p, e in zip(prior, evidence)]
        plain = np.exp(np.array(score) - max(score))
        assert np.allclose(plain / plain.sum(), [r.p_a, r.p_b, r.p_c], atol=2e-3)


def test_steps_go_on_until_the_least_squares(spark):
    """A target that no rates reach: the result is where no rate can improve the squares."""
    rows = [(i, "ant " * (i % 5 + 1) + ("bee" if i % 4 == 0 else "the")) for i in range(80)]
    df = spark.createDataFrame(rows, DOCS)
    labelled = df.select("doc_id", F.when(F.col("doc_id") % 4 == 0, "b").otherwise("a").alias("domain"))
    out = mixing.mix_to_targets(df, labelled, {"a": 0.0001, "b": 0.9999}).collect()
    t, r, p = np.array([x.n_tokens for x in out], float), np.array([x.rate for x in out]), np.array([[x.p_a, x.p_b] for x in out])
    share = (t * r) @ p / t.sum()
    assert np.allclose(share, [out[0].achieved_a, out[0].achieved_b], atol=1e-5)
    metric = np.linalg.inv((p * t[:, None]).T @ p / t.sum() + 1e-6 * np.eye(2))
    slope = p @ metric @ (share - np.array([0.0001, 0.9999])) + 1e-3 * (r - 1)
    assert (np.abs(slope[r > 0]) < 1e-2).all() and (slope[r == 0] > -1e-2).all()


def test_steps_always_end_and_the_objective_falls():
    """The driver's side with all documents in numpy: random targets, most of which no rates reach."""
    rng = np.random.default_rng(0)
    ends = {"met": 0, "missed": 0}
    for case in range(60):
        n, rows = int(rng.integers(2, 6)), int(rng.integers(5, 1500))
        p, t = rng.dirichlet(rng.uniform(0.05, 3, size=n), size=rows), rng.integers(1, 1000, size=rows).astype(float)
        reachable = case % 2 == 0
        goal = (t * rng.gamma(0.5, 1, size=rows)) @ p if reachable else rng.dirichlet(np.full(n, 0.5))
        goal, total = goal / goal.sum(), t.sum()
        moments = lambda w: np.linalg.inv((p * w[:, None]).T @ p / total + 1e-6 * np.eye(n))
        step = lambda r, x: np.maximum(0, r - (p @ np.array(x) + 1e-3 * (r - 1)) / 1.001)
        told = lambda r: ((t * r) @ p / total, float((t * (r - 1) ** 2).sum() / total))
        search, r, done = mixing._Search(goal.tolist(), moments(t), 1e-4, 1e-6, 1e-3), np.ones(rows), 0
        while not search.over(*told(r), done):
            rates = [step(r, x) for x in search.steps(moments(t * (r > 0)), done)]
            values = [search.value(*told(x)) for x in rates]
            assert min(values) <= search.value(*told(r)) + 1e-12
            search.moved = float((t * np.abs(rates[0] - r)).sum() / total)
            r, done = rates[int(np.argmin(values))], done + 1
            assert done < 400
        ends["met" if search.kept is None else "missed"] += 1
        assert not reachable or np.abs(told(r)[0] - goal).max() < 3e-3
    assert ends["met"] >= 30 and ends["missed"] >= 10


def test_targets_are_met_on_the_tables(spark):
    out = mixing.op4_mixing(spark, "/root/testdata/sf0.01")
    p = [f"sum(n_tokens * rate * p_{d}) / sum(n_tokens) AS {d}" for d in mixing.TARGETS]
    got = out.selectExpr(*p).first().asDict()
    told = out.selectExpr(*[f"max(achieved_{d}) AS {d}" for d in mixing.TARGETS]).first().asDict()
    for d, goal in mixing.TARGETS.items():
        assert abs(got[d] - goal) < 0.005 and abs(told[d] - got[d]) < 1e-6


def test_evidence_is_the_sum_over_places(spark):
    """Bins that weigh for one domain only, the first and the last of all bins, bins that weigh nowhere."""
    weight = [[0.0] * mixing.BINS for _ in range(2)]
    weight[0][0], weight[0][700], weight[1][700], weight[1][mixing.BINS - 1] = 0.5, -1.25, 2.0, 4.0
    model = mixing.Domains(["a", "b"], [0.5, 0.5], weight, [-0.125, 0.25])
    rows = [[], [0], [0, 700, 5], [mixing.BINS - 1, 699, 701], [700, mixing.BINS - 1, 0]]
    df = spark.createDataFrame([(b,) for b in rows], "bins array<int>").coalesce(1).select("bins", F.transform("bins", model.place()).alias("places"))
    got = df.select("bins", *model.evidence(F.col("places"))).collect()
    assert [(a, b) for _, a, b in got] == [tuple(x + sum(w[b] for b in bins) for x, w in zip((-0.125, 0.25), weight)) for bins in rows]


def test_the_query_stages_no_texts(spark):
    """The texts are read once for the scores; what the steps and the result read holds numbers only."""
    from caselake.llm.common import table

    out = mixing.op4_mixing(spark, "/root/testdata/sf0.001")
    held = spark.read.parquet(*{f.rpartition("/")[0] for f in out.inputFiles()})
    assert "text" not in held.columns and held.count() == out.count()
    docs, labels = table(spark, "/root/testdata/sf0.001", "documents"), table(spark, "/root/testdata/sf0.001", "labels")
    whole = mixing.mix_to_targets(docs.select("doc_id", "text"), mixing.label_domains(labels), mixing.TARGETS)
    assert [c for c in whole.columns if c != "text"] == out.columns
    assert sorted(map(tuple, whole.select("doc_id", "n_tokens", "copies").collect())) == sorted(map(tuple, out.select("doc_id", "n_tokens", "copies").collect()))
    assert {r.doc_id: r.text for r in whole.collect()} == {r.doc_id: r.text for r in docs.collect()}


def test_mixing_keeps_columns_of_any_name(spark):
    df = spark.createDataFrame([(1, "ant the", "w"), (2, "bee the", "w"), (3, None, "w")], DOCS + ", words string").selectExpr("*", "words AS kinds", "words AS bins", "words AS evidence", "words AS _e0", "words AS was", "words AS r", "words AS achieved_a")
    out = mixing.mix_to_targets(df, df.selectExpr("doc_id", "if(doc_id = 1, 'a', 'b') AS domain"), {"a": 1.0, "b": 1.0})
    assert set(df.columns) < set(out.columns) and len(out.columns) == len(set(out.columns))
    assert {(x.words, x.kinds, x.bins, x.evidence, x._e0, x.was, x.r) for x in out.collect()} == {("w",) * 7}


# ---- urls ----


def test_urls_keep_columns_of_any_name(spark):
    names = ["prediction", "probability", "rawPrediction", "features", "raw", "_suffix", "_features", "_share0", "share", "seen", "suffix", "Prediction2"]
    labelled = judge_by_rules(spark.createDataFrame([(f"http://h{i % 7}.example.com/{'en' if i % 2 else 'xx'}/{i}", i % 2) for i in range(60)], "url string, blocked int"), ())
    model = fit_urls(labelled, trees=2)
    df = labelled.select("url", *[F.lit(c).alias(c) for c in names])
    out = judge_urls(df, model, ())
    assert out.columns[: len(df.columns)] == df.columns and out.count() == 60
    assert all(tuple(r[c] for c in names) == tuple(names) for r in out.collect())


def test_rules_equal_their_sql(spark, tmp_path):
    import duckdb

    urls = ["http://X.example.COM/en/9", "http://example.com/en/7x", "ftp://a.net/de/1?x#y", "http://example.net/de/8", "org/es/", "http://org/es/", None, "", "http://com/en/://x", "http://a\nb.com/en/\n7"]
    spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string").coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    got = sorted(tuple(r) for r in url_rules(spark, str(tmp_path)).select("page_id", "host", "path", "rule", "rule_verdict").collect())
    want = duckdb.connect().execute(f"WITH pages AS (SELECT * FROM '{tmp_path}/pages.parquet/*.parquet') {URL_RULES_SQL.strip().replace('WITH u AS', ', u AS', 1)}").fetchall()
    assert got == sorted(want)
