"""URL filters: host and path rules, and boosted trees where no rule fits.

The trees read lexical features of the url and statistics of its host's
suffixes, gathered over the labelled urls.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh, staged, table, unstage
from .near_duplicates import few

# The rules, as verdict, host and path.
RULES = (
    ("block", "com", "/en/"),
    ("allow", "example.com", "/en/7"),
    ("allow", "net", "/de/"),
    ("block", "example.net", "/de/8"),
    ("block", "org", "/es/"),
)

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Bound on the labelled urls that the trees are fitted on, those of the smallest hash.
MAX_TRAIN_ROWS = 50_000
#: Up to so many suffixes of one length (some 50 bytes each) are broadcast.
BROADCAST_SUFFIXES = 20_000


def host_of(url: Column) -> Column:
    """What stands after the first ://, up to /, ? or # or the end, A-Z lower-cased; else empty."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """What follows the host, up to ? or # or the end; else empty."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def judge_by_rules(urls: DataFrame, rules: tuple[tuple[str, str, str], ...] = RULES) -> DataFrame:
    """``urls`` (url) with host, path, rule and rule_verdict.

    A rule fits its host and everything under it if the path starts with the
    rule's; of several the longest (host and path together) wins, and of equally
    long ones a block.  Without a fitting rule both are null; so it is for a
    null url or one without ://.  Columns of those names are replaced.
    """
    told = urls.withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url")))
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, host, path in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[0] == "block")):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        rule = F.when(fits, F.lit(host + path)).otherwise(rule)
        verdict = F.when(fits, F.lit(v)).otherwise(verdict)
    return told.withColumns({"rule": rule, "rule_verdict": verdict})


def _entropy(s: Column) -> Column:
    """Shannon entropy of the characters, in bits."""
    chars = F.filter(F.split(s, ""), lambda c: c != "")
    n = F.size(chars)
    share = lambda c: F.size(F.filter(chars, lambda x: x == c)) / n
    return F.when(n > 0, F.aggregate(F.array_distinct(chars), F.lit(0.0), lambda acc, c: acc - share(c) * F.log2(share(c)))).otherwise(0.0)


def _suffixes(host: Column) -> list[Column]:
    """The last one, two and three labels of the host."""
    return [F.substring_index(host, ".", -k) for k in (1, 2, 3)]


def _lexical(url: Column, host: Column, path: Column) -> list[Column]:
    url = F.coalesce(url, F.lit(""))
    query = F.regexp_extract(url, r"(?s)\?([^#]*)", 1)
    count = lambda s, signs: F.char_length(F.regexp_replace(s, f"[^{signs}]", "")).cast("double")
    ratio = lambda s, signs: F.coalesce(F.try_divide(count(s, signs), F.char_length(s)), F.lit(0.0))
    parts = F.split(path, "/")
    return [
        F.char_length(url).cast("double"),
        F.char_length(host).cast("double"),
        F.char_length(path).cast("double"),
        F.size(F.filter(parts, lambda x: x != "")).cast("double"),
        count(host, "."),
        count(url, "-"),
        ratio(url, "0-9"),
        ratio(host, "0-9"),
        count(path, "0-9"),
        _entropy(host),
        _entropy(path),
        F.when(query == "", 0.0).otherwise(F.size(F.split(query, "&")).cast("double")),
        F.char_length(query).cast("double"),
        F.startswith(F.lower(url), F.lit("https://")).cast("double"),
        F.contains(url, F.lit("#")).cast("double"),
        F.char_length(F.get(F.filter(parts, lambda x: x != ""), F.lit(0))).cast("double"),
        F.coalesce(F.pmod(F.xxhash64(F.get(F.filter(parts, lambda x: x != ""), F.lit(0))), F.lit(64)).cast("double"), F.lit(-1.0)),
        F.coalesce(F.ascii(F.get(F.filter(parts, lambda x: x != ""), F.lit(1))).cast("double"), F.lit(-1.0)),
    ]


class UrlModel:
    """Fitted trees, and for each suffix its smoothed share of blocked urls."""

    def __init__(self, trees: object | None, suffixes: list[DataFrame], share: float) -> None:
        self.trees, self.suffixes, self.share = trees, suffixes, share


def _features(urls: DataFrame, suffixes: list[DataFrame], share: float, name: str) -> DataFrame:
    """``urls`` with a vector called ``name``; all their own columns stay, whatever they are called."""
    out, known = urls, []
    for k, s in enumerate(suffixes):
        key, rate, seen = fresh(out, "suffix", "share", "seen")
        statistics = s.select(F.col("_suffix").alias(key), F.col(f"_share{k}").alias(rate), F.col(f"_seen{k}").alias(seen))
        out = out.withColumn(key, _suffixes(F.col("host"))[k]).join(few(statistics, BROADCAST_SUFFIXES), key, "left")
        known += [(rate, share), (seen, 0.0)]
    numbers = F.array(*_lexical(F.col("url"), F.col("host"), F.col("path")), *[F.coalesce(F.col(c), F.lit(d)) for c, d in known])
    return out.withColumn(name, array_to_vector(F.transform(numbers, lambda x: F.coalesce(x, F.lit(-1.0))))).select(*[F.col(f"`{c}`") for c in urls.columns], name)


def fit_urls(labelled: DataFrame, max_rows: int = MAX_TRAIN_ROWS, trees: int = 12, depth: int = 4) -> UrlModel:
    """Fit on at most ``max_rows`` distinct rows of ``labelled`` (url, host, path, blocked 0 or 1).

    The statistics of all suffixes are counted over all distinct rows, also
    beyond that bound; those of a training row leave out that row's own fold.  Null urls or labels teach
    nothing.  With fewer than two classes there are no trees, and every url
    gets the share of blocked ones.
    """
    known = labelled.filter(F.col("url").isNotNull() & F.col("blocked").isNotNull()).select("url", "host", "path", F.col("blocked").cast("double").alias("blocked")).distinct()
    known = staged(known.withColumn("_fold", F.pmod(F.xxhash64("url", F.lit(3)), F.lit(2))), "labelled")
    rows = staged(known.orderBy(F.xxhash64("url"), "url", "blocked").limit(max_rows), "urls")
    n, blocked = known.agg(F.count("*"), F.coalesce(F.sum("blocked"), F.lit(0.0))).first()
    share = (blocked + 1.0) / (n + 2.0)
    if blocked in (0, n) or rows.select("blocked").distinct().count() < 2:
        return UrlModel(None, [], share)

    def statistics(part: DataFrame) -> list[DataFrame]:
        out = []
        for k in range(3):
            seen = part.groupBy(_suffixes(F.col("host"))[k].alias("_suffix")).agg(F.count("*").alias("n"), F.sum("blocked").alias("b"))
            out.append(seen.select("_suffix", ((F.col("b") + 8 * share) / (F.col("n") + 8)).alias(f"_share{k}"), F.log2(F.col("n") + 1.0).alias(f"_seen{k}")))
        return out

    folds = [_features(rows.filter(F.col("_fold") == f), [staged(s, "fold") for s in statistics(known.filter(F.col("_fold") != f))], share, "_features") for f in (0, 1)]
    train = staged(folds[0].unionByName(folds[1]).select(vector_to_array("_features").alias("_features"), "blocked"), "features")
    trees_ = GBTClassifier(featuresCol="_features", labelCol="blocked", maxIter=trees, maxDepth=depth, maxBins=64, stepSize=0.3, seed=5, cacheNodeIds=False)
    fitted = trees_.fit(train.select(array_to_vector("_features").alias("_features"), "blocked"))
    final = [staged(s, "suffixes") for s in statistics(known)]
    unstage(train)
    unstage(known)
    unstage(rows)
    return UrlModel(fitted, final, share)


def judge_urls(urls: DataFrame, model: UrlModel, rules: tuple[tuple[str, str, str], ...] = RULES, threshold: float = 0.5) -> DataFrame:
    """``urls`` (url and any other columns) with host, path, rule, verdict and risk.

    The verdict is the rule's if one fits, else block when the trees' probability
    risk is ``threshold`` or more.  A null or malformed url has an empty host and
    path and is judged by the trees like any other.  Columns of the new names
    are replaced, all others stay; no row is dropped or repeated.
    """
    ruled = judge_by_rules(urls.drop("host", "path", "rule", "verdict", "risk"), rules)
    told = fresh(ruled, "features", "raw", "probability", "prediction")
    if model.trees is None:
        scored = ruled.withColumn("risk", F.lit(model.share))
    else:
        features, raw, probability, prediction = told
        trees = model.trees.copy().setFeaturesCol(features).setRawPredictionCol(raw).setProbabilityCol(probability).setPredictionCol(prediction)
        scored = trees.transform(_features(ruled, model.suffixes, model.share, features))
        scored = scored.withColumn("risk", F.get(vector_to_array(probability), F.lit(1))).drop(*told)
    verdict = F.coalesce("rule_verdict", F.when(F.col("risk") >= threshold, "block").otherwise("allow"))
    return scored.withColumn("verdict", verdict).drop("rule_verdict")


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A verdict on every page's url; the urls that a rule fits are the labelled ones."""
    urls = table(spark, sf_dir, "pages").select("page_id", "url")
    labelled = judge_by_rules(urls).filter("rule IS NOT NULL").withColumn("blocked", (F.col("rule_verdict") == "block").cast("int"))
    return judge_urls(urls, fit_urls(labelled)).select("page_id", "host", "path", "rule", "verdict", "risk")


def url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the rules alone say of every page's url."""
    return judge_by_rules(table(spark, sf_dir, "pages").select("page_id", "url")).select("page_id", "host", "path", "rule", "rule_verdict")


URL_RULES_SQL = """
WITH u AS (
  SELECT page_id,
    translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
rules(verdict, h, p) AS (VALUES ('block', 'com', '/en/'), ('allow', 'example.com', '/en/7'), ('allow', 'net', '/de/'), ('block', 'example.net', '/de/8'), ('block', 'org', '/es/')),
fit AS (
  SELECT page_id, verdict, h || p AS rule, row_number() OVER (PARTITION BY page_id ORDER BY length(h || p) DESC, verdict DESC) AS r
  FROM u JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p))
SELECT u.page_id, host, path, rule, verdict AS rule_verdict FROM u LEFT JOIN fit ON fit.page_id = u.page_id AND r = 1
"""
