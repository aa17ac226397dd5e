"""Mixing documents towards target shares of domains (DataFrame functions only).

A naive Bayes classifier, trained on labelled documents, gives every document a
posterior over the domains.  A document counts with its tokens towards each
domain in proportion.  Nonnegative rates, one for each document, are then
fitted by projected gradient steps so that the expected tokens of each domain
match its target share, while rates stay near 1 where the targets leave room.

A step needs a few sums over the whole corpus, the surplus of each domain and
second moments of the posteriors, and a document's rate follows from its
posterior and the surpluses so far.  Steps go on until the targets are met or no
rate moves any more.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh, staged, table, unstage

BINS = 1 << 16
#: A bin weighs only if its log-likelihood ratio between a domain and the rest is as high as chance makes it once in a thousand times.
LEAST_RATIO = 10.83
#: Bound on the labelled rows that train the classifier, those of the smallest hash of doc_id.
MAX_TRAIN_ROWS = 30_000
TEMPERATURES = (1, 2, 4, 8, 16, 32, 64, 128, 256)
#: Target shares of tokens in the query and in the pipeline.
TARGETS = {"high": 0.85, "low": 0.06, "toxic": 0.09}


def _words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def _signs(text: Column, n: Column, letters: Column, kinds: Column) -> Column:
    """Marks that stand beside ``n`` words of so many letters: length, share of other signs, share of distinct words."""
    share = lambda part, whole: F.floor(F.coalesce(F.try_divide(part * 16, whole), F.lit(0))).cast("string")
    return F.array(
        F.concat(F.lit("#words "), F.floor(F.log2(n + 1.0)).cast("string")),
        F.concat(F.lit("#signs "), share(F.char_length(F.coalesce(text, F.lit(""))) - letters - n, letters)),
        F.concat(F.lit("#distinct "), share(kinds, n)),
    )


def _bin(word: Column) -> Column:
    return F.xxhash64(word).bitwiseAND(F.lit(BINS - 1)).cast("int")


def _told(docs: DataFrame, n_tokens: str, bins: str, number: Callable[[Column], Column] = lambda b: b) -> DataFrame:
    """``docs`` with the number of its words, and the distinct bins of its words and signs, or what ``number`` makes of each bin.

    Each step is a column of its own, so that no part is worked out twice.  What
    needs all words stands before the hashes: lambdas are not compiled, and the
    rows that reach them are copied.
    """
    words, kinds, letters = fresh(docs, "words", "kinds", "letters")
    told = docs.withColumn(words, _words(F.col("text")))
    told = told.withColumns({kinds: F.array_distinct(words), n_tokens: F.size(words).cast("long"), letters: F.char_length(F.array_join(words, ""))}).drop(words)
    signs = _signs(F.col("text"), F.col(n_tokens), F.col(letters), F.size(kinds))
    told = told.withColumn(bins, F.array_distinct(F.transform(F.concat(F.col(kinds), signs), lambda w: number(_bin(w)))))
    return told.drop(kinds, letters)


def _constant(value: list, kind: str) -> Column:
    """A literal array; Catalyst folds it once."""
    return F.from_json(F.lit(json.dumps(value)), kind)


def likelihood_ratio(n: int, seen: int, held: int, total: int) -> float:
    """Of ``n`` rows of a domain of ``held`` that have a bin, where ``seen`` of all ``total`` rows have it."""
    cells = [(n, seen * held), (seen - n, seen * (total - held)), (held - n, (total - seen) * held), (total - held - seen + n, (total - seen) * (total - held))]
    return 2 * sum(o * math.log(o * total / e) for o, e in cells if o)


class Domains:
    """A trained classifier: for each domain the log weight of each bin that is there and of all that are not, priors, a temperature."""

    def __init__(self, names: list[str], prior: list[float], weight: list[list[float]], away: list[float], temperature: float = 1.0) -> None:
        self.names, self.prior, self.weight, self.away, self.temperature = names, prior, weight, away, temperature
        self.weighing = [b for b in range(BINS) if any(w[b] for w in weight)]

    def place(self) -> Callable[[Column], Column]:
        """What gives a bin's place among those that weigh, from 1, and 0 for all others."""
        places = [0] * BINS
        for n, b in enumerate(self.weighing, 1):
            places[b] = n
        held = _constant(places, "array<int>")
        return lambda b: F.get(held, b)

    def evidence(self, places: Column) -> list[Column]:
        """Each domain's sum of log weights over distinct bins, there or not; ``places`` are those of the bins that are."""
        weights = [_constant([0.0, *(w[b] for b in self.weighing)], "array<double>") for w in self.weight]
        add = lambda w: lambda total, at: total + F.get(w, at)
        return [F.aggregate(places, F.lit(float(a)), add(w)) for a, w in zip(self.away, weights)]

    def posterior(self, evidence: list[Column], temperature: float) -> list[Column]:
        score = [math.log(p) + e / float(temperature) for p, e in zip(self.prior, evidence)]
        top = F.greatest(*score) if len(score) > 1 else score[0]
        parts = [F.exp(s - top) for s in score]
        total = sum(parts[1:], parts[0])
        return [p / total for p in parts]


def fit_domains(docs: DataFrame, labelled: DataFrame, names: list[str], max_rows: int = MAX_TRAIN_ROWS) -> Domains:
    """Train on at most ``max_rows`` rows of ``labelled`` (doc_id, domain) with their texts in ``docs``.

    Bins that are not in a document count as much as those that are.  Four fifths
    of the rows give the weights; on the last fifth the temperature that
    gives the likeliest labels is chosen.  Null ids, null domains and domains
    outside ``names`` teach nothing; of several labels of an id the smallest
    counts.  Without labelled rows all posteriors are equal.
    """
    known = labelled.filter(F.col("doc_id").isNotNull() & F.col("domain").isin(names)).groupBy("doc_id").agg(F.min("domain").alias("domain"))
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    texts = _told(docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id"), "n", "bins")
    rows = staged(texts.select((F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(5)) == 0).alias("test"), "domain", "bins"), "labelled")
    train = rows.filter("NOT test")
    sizes = {r[0]: r[1] for r in train.groupBy("domain").count().collect()}
    bins = train.select("domain", F.explode("bins").alias("bin"))
    found = bins.groupBy("domain", "bin").count().toArrow()
    counts = dict(zip(zip(found["domain"].to_pylist(), found["bin"].to_pylist()), found["count"].to_pylist()))
    total = sum(sizes.values())
    whole: dict[int, int] = {}
    for (_, b), n in counts.items():
        whole[b] = whole.get(b, 0) + n
    prior = [(sizes.get(d, 0) + 1) / (total + len(names)) for d in names]
    weight, away = [], []
    for d in names:
        held, others = sizes.get(d, 0), total - sizes.get(d, 0)
        row = [0.0] * BINS
        away.append(0.0)
        for b, seen in whole.items():
            n = counts.get((d, b), 0)
            p, q = (n + 0.5) / (held + 1), (seen - n + 0.5) / (others + 1)
            if likelihood_ratio(n, seen, held, total) >= LEAST_RATIO:
                absent = math.log((1 - p) / (1 - q))
                row[b] = round(math.log(p / q) - absent, 4)
                away[-1] += absent
        weight.append(row)
    model = Domains(names, prior, weight, away)
    places = rows.filter("test").select("domain", F.transform("bins", model.place()).alias("places"))
    evidence = places.select("domain", *[e.alias(f"e{i}") for i, e in enumerate(model.evidence(F.col("places")))])
    gains = []
    for t in TEMPERATURES:
        p = model.posterior([F.col(f"e{i}") for i in range(len(names))], t)
        gains.append(F.avg(F.log(F.greatest(F.lit(1e-9), F.coalesce(*[F.when(F.col("domain") == d, x) for d, x in zip(names, p)])))))
    gained = evidence.agg(*gains).first()
    unstage(rows)
    best = max(range(len(TEMPERATURES)), key=lambda i: (gained[i] if gained[i] is not None else 0.0, -i))
    model.temperature = float(TEMPERATURES[best])
    return model


def _step(rate: Column, posterior: list[Column], surplus: Column, rate_pull: float) -> Column:
    push = sum((p * F.get(surplus, F.lit(k)) for k, p in enumerate(posterior)), F.lit(0.0))
    return F.greatest(F.lit(0.0), rate - (push + rate_pull * (rate - 1.0)) / (1.0 + rate_pull))


def _rates(start: Column, posterior: list[Column], surpluses: list[list[float]], rate_pull: float) -> Column:
    if not surpluses:
        return start
    return F.aggregate(_constant(surpluses, "array<array<double>>"), start, lambda r, s: _step(r, posterior, s, rate_pull))


class _Search:
    """The driver's side of the steps: how long they are, what they gain, and when they end.

    The objective is half the squares of what the shares are off, in the metric of
    all documents, and ``rate_pull`` halves of the rates' squared distance from 1.
    A plain step never raises it.  From ``PLAIN`` steps on longer ones are tried in
    the same pass over the documents, and the one that lowers it most is taken.
    """

    PLAIN, WINDOW, GAIN = 16, 6, 1e-2

    def __init__(self, goal: list[float], metric: np.ndarray, tolerance: float, still: float, rate_pull: float) -> None:
        self.goal, self.aim, self.metric = np.array(goal), np.array(goal), metric
        self.tolerance, self.still, self.rate_pull = tolerance, still, rate_pull
        self.values: list[float] = []
        self.moved, self.miss, self.off = float("inf"), float("inf"), np.zeros(len(goal))
        #: if targets can't be met: how many steps led to the least squares, and the shares there
        self.kept: int | None = None
        self.share: list[float] = []

    def value(self, share: list[float], pull: float) -> float:
        off = np.array(share) - self.aim
        return float(0.5 * off @ self.metric @ off + 0.5 * self.rate_pull * pull)

    def over(self, share: list[float], pull: float, done: int) -> bool:
        """True when targets are met, or can't be: the least squares for ``goal`` are then ``kept``.

        Where the squares fall no more though targets are missed, the pull of the
        rates may be what holds them, so the aim is moved on by what is missed.  If
        that does not bring the targets nearer by a third, no rates reach them.
        """
        miss = np.array(share) - self.goal
        self.off = np.array(share) - self.aim
        if np.abs(miss).max() <= self.tolerance:
            self.kept = None
            return True
        self.values.append(self.value(share, pull))
        ended = self.moved <= self.still or len(self.values) > self.WINDOW and self.values[-1] > (1 - self.GAIN) * self.values[-1 - self.WINDOW]
        if done < self.PLAIN or not ended:
            return False
        if self.kept is None:
            self.kept, self.share = done, list(share)
        if np.abs(miss).max() > 0.7 * self.miss:
            return True
        self.miss, self.values, self.moved = float(np.abs(miss).max()), [], float("inf")
        self.aim = self.aim - miss
        self.off = np.array(share) - self.aim
        return False

    def steps(self, metric: np.ndarray, done: int) -> list[list[float]]:
        """What is to be tried: a plain step, and from some on one in ``metric``, of the documents that still have a rate, and longer ones."""
        plain = self.metric @ self.off
        return [x.tolist() for x in ([plain] if done < self.PLAIN else [plain, metric @ self.off, 4 * plain, 16 * plain])]


def mix_to_targets(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], max_rows: int = MAX_TRAIN_ROWS, steps: int | None = None, tolerance: float = 1e-4, still: float = 1e-6, rate_pull: float = 1e-3, seed: int = 17, without: tuple[str, ...] = ()) -> DataFrame:
    """``docs`` with n_tokens, p_<domain> and achieved_<domain> for each target, rate and copies.

    ``docs`` has doc_id and text and any other columns, ``labelled`` doc_id and
    domain; ``targets`` gives each domain's share of the corpus' tokens.  rate is
    the expected number of times a document is to be taken, copies a whole
    number of that expectation, drawn by a hash of doc_id and text.  achieved_
    columns hold, on every row, the shares that these rates give.  Columns named
    in ``without`` are read, but neither staged nor returned.

    A null or empty text has no tokens and the prior as its posterior.  Without
    any tokens all rates are 1 and achieved shares are null.  No row is dropped,
    whatever its rate; repeated rows are weighed each.  Columns of the new names
    are replaced, all others stay.  Each step lowers the objective (``_Search``).
    Steps end when no domain is off by more than ``tolerance`` of all tokens, or
    when a step moves less than ``still`` of them or six lower the objective by
    less than a hundredth: then the rates are those of the least squares, and
    targets that no rates reach show in achieved_.  ``steps`` ends it earlier, if
    given.
    """
    names = sorted(targets)
    goal = [targets[d] / sum(targets.values()) for d in names]
    model = fit_domains(docs, labelled, names, max_rows)
    p_names = [f"p_{d}" for d in names]
    held = docs.drop("n_tokens", *p_names, *[f"achieved_{d}" for d in names], "rate", "copies")
    places, draw, *evidence = fresh(held, "places", "draw", *[f"evidence_{d}" for d in names])
    told = _told(held, "n_tokens", places, model.place())
    told = told.withColumns(dict(zip(evidence, model.evidence(F.col(places))))).drop(places)
    told = told.withColumns(dict(zip(p_names, model.posterior([F.col(e) for e in evidence], model.temperature)))).drop(*evidence)
    told = told.withColumn(draw, F.pmod(F.xxhash64(F.lit(seed), "doc_id", "text"), F.lit(1 << 20)) / float(1 << 20))
    told = staged(told.drop(*without), "told")

    posterior = [F.col(p) for p in p_names]
    slim = told.filter("n_tokens > 0").select("n_tokens", *p_names).withColumn("rate", F.lit(1.0))
    n, own, tokens = len(names), None, F.col("n_tokens")
    pairs = np.tril_indices(n)
    weigh = lambda w: [F.sum(w * posterior[i] * posterior[j]) for i, j in zip(*pairs)]
    sums = slim.agg(F.sum("n_tokens"), *[F.sum(tokens * p) for p in posterior], *weigh(tokens)).first()
    total = float(sums[0] or 0)
    surpluses: list[list[float]] = []
    share: list[float | None] = [None] * n
    if total:
        # steps are taken in the metric of the posteriors' second moments, so domains that overlap converge alike
        def metric_of(moments: list[float]) -> np.ndarray:
            whole = np.zeros((n, n))
            whole[pairs] = whole.T[pairs] = moments
            return np.linalg.inv(whole / total + 1e-6 * np.eye(n))

        metric = metric_of(sums[n + 1 :])
        search = _Search(goal, metric, tolerance, still, rate_pull)
        share, pull, moments, fresh_ = [x / total for x in sums[1 : n + 1]], 0.0, sums[n + 1 :], []
        while not search.over(share, pull, len(surpluses)) and len(surpluses) != steps:
            tried = search.steps(metric_of(moments), len(surpluses))
            now = slim.withColumn("was", _rates(F.col("rate"), posterior, fresh_, rate_pull))
            now = now.withColumns({f"r{i}": _rates(F.col("was"), posterior, [x], rate_pull) for i, x in enumerate(tried)})
            found = now.agg(*[
                x for r in (F.col(f"r{i}") for i in range(len(tried)))
                for x in (F.sum(tokens * F.abs(r - F.col("was"))), F.sum(tokens * (r - 1.0) * (r - 1.0)), *[F.sum(tokens * r * p) for p in posterior], *weigh(F.when(r > 0, tokens).otherwise(0)))
            ]).first()
            wide = 2 + n + len(pairs[0])
            ends = [found[i * wide : (i + 1) * wide] for i in range(len(tried))]
            search.moved = ends[0][0] / total
            best = min(range(len(tried)), key=lambda i: search.value([x / total for x in ends[i][2 : n + 2]], ends[i][1] / total))
            share, pull, moments = [x / total for x in ends[best][2 : n + 2]], ends[best][1] / total, ends[best][n + 2 :]
            fresh_.append(tried[best])
            surpluses.append(tried[best])
            if len(fresh_) == 8:  # keep the rates so far, so that a step costs the same early and late
                slim, own, old = staged(slim.withColumn("rate", _rates(F.col("rate"), posterior, fresh_, rate_pull)), "posteriors"), True, slim if own else None
                if old is not None:
                    unstage(old)
                fresh_ = []
        if search.kept is not None:
            surpluses, share = surpluses[: search.kept], search.share
        if own:
            unstage(slim)
    rated = told.withColumn("rate", _rates(F.lit(1.0), posterior, surpluses, rate_pull))
    rated = rated.withColumn("copies", F.floor(F.col("rate") + F.col(draw)).cast("long")).drop(draw)
    return rated.withColumns({f"achieved_{d}": F.lit(x).cast("double") for d, x in zip(names, share)})


def label_domains(labels: DataFrame) -> DataFrame:
    """The domain of each labelled document: toxic, else high or low by its quality."""
    domain = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "high").when(F.col("quality") == 0, "low")
    return labels.select("doc_id", domain.alias("domain"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posteriors, rate and copies of every document for the target shares."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return mix_to_targets(docs, label_domains(table(spark, sf_dir, "labels")), TARGETS, without=("text",))
