"""URL filter: rules first, then a hashed n-gram logistic regression [native].

A URL is cut into host and path.  Rules (a host, its subdomains and a path
prefix) judge what they fit, the longest rule winning.  Every other URL is
scored by a logistic regression on hashed character n-grams of host and
path, trained from a small labelled URL table.

Scale: one narrow pass over the URL column, no shuffle; rules and model
(``DIMENSIONS`` doubles) are constants of the plan.  DataFrame functions
and the DataFrame-based ``pyspark.ml`` only.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DIMENSIONS = 8192
NGRAMS = (3, 4, 5)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Rule(NamedTuple):
    verdict: str
    rule: str  # host, "/" and the rest of the path's start


#: Rules of the registered query.
RULES = (Rule("block", "net/"), Rule("allow", "example.net/en/"),
         Rule("block", "example.com/de/"), Rule("allow", "org/fr/"))

#: The labelled URL table: unwanted kinds of sites, and ordinary ones.
BLOCKED_URLS = (
    "http://casino-royal.test/win/1", "https://www.casino-bonus.test/play", "https://win-casino.test/slots/777",
    "http://free-casino.test/bets", "https://best-bets.test/odds", "http://free-bets-online.test/bet",
    "https://sports-betting.test/free-bets", "http://poker-win.test/jackpot", "https://jackpot-slots.test/spin",
    "https://adult-cams.test/x/1", "http://adult-x-videos.test/watch", "https://xxx-adult.test/gallery/2",
    "http://www.adult-dating.test/meet", "https://porn-x.test/videos/9", "https://sex-cams.test/live",
    "http://cheap-pills-online.test/buy", "https://cheap-meds.test/pills", "https://pills-discount.test/order/3",
    "http://buy-viagra-pills.test/cheap", "https://ads-server.test/track?id=1", "http://ads-track-er.test/click",
    "https://track-ads.test/pixel", "https://ad-tracker.test/track/click", "http://banner-ads.test/serve",
    "http://spam-links.test/seo", "https://link-farm-spam.test/out/5", "https://spam-farm-seo.test/links",
    "http://spam-blog-farm.test/page/2", "https://malware-download.test/setup.exe", "http://phish-login.test/verify/account",
)
ALLOWED_URLS = (
    "https://news.test/en/articles/1", "https://www.city-library.test/catalogue", "http://university.test/physics/papers",
    "https://blog.gardening.test/en/1042.html", "https://m.weather.test/fr/3310", "https://docs.project.test/guide/install",
    "http://museum.test/de/exhibitions/7", "https://recipes.test/es/soup/44", "https://www.theatre.test/en/25171",
    "http://forum.bikes.test/thread/88213", "https://encyclopedia.test/wiki/Tree", "https://m.trains.test/de/plan",
    "https://health.gov.test/en/advice/vaccines", "http://school.test/lessons/12.html", "https://open-data.test/tables/9",
    "https://www.football.test/en/results", "https://books.test/fr/23417/", "http://blog.thread.test/en/31586",
    "https://maps.test/es/13216/", "https://www.parliament.test/en/bills/204", "https://code.test/project/issues/51",
    "http://m.other.test/en/1265?page=2&ref=x", "https://shop.test/en/shoes/10", "https://music.test/albums/66",
    "https://science.test/en/21931?page=2&ref=x", "https://history.test/de/2752/", "http://www.thinking.test/de/25835.html",
    "https://local-news.test/en/39970", "https://travel.test/fr/33907?utm_source=feed", "https://chess.test/en/27371#top",
)


def labelled_urls(spark: SparkSession) -> DataFrame:
    """The labelled URL table: ``url``, ``label`` (1: block)."""
    rows = [(u, 1.0) for u in BLOCKED_URLS] + [(u, 0.0) for u in ALLOWED_URLS]
    return spark.createDataFrame(rows, "url string, label double").coalesce(1)


def _after_scheme(url: Column) -> Column:
    return F.when(url.contains("://"), F.expr("substr({u}, instr({u}, '://') + 3)".format(u="_url")))


def with_host_and_path(df: DataFrame, url: str = "url") -> DataFrame:
    """Add ``_host`` and ``_path``: after the first ``://`` up to ``/``,
    ``?``, ``#`` or the end, A to Z lower-cased; then up to ``?``, ``#`` or
    the end.  Null, or no ``://``: both empty."""
    rest = F.coalesce(_after_scheme(F.col("_url")), F.lit(""))
    return (df.withColumn("_url", F.col(f"`{url}`")).withColumn("_rest", rest)
            .withColumn("_host", F.translate(F.regexp_extract("_rest", r"^([^/?#]*)", 1), UPPER, LOWER))
            .withColumn("_path", F.regexp_extract("_rest", r"^[^/?#]*([^?#]*)", 1))
            .drop("_url", "_rest"))


def rule_columns(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits; null where none does.
    Of rules of equal length the first given wins."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    # shortest first, so that the longest is tested first; later ones inside
    for r in sorted(reversed(rules), key=lambda x: len(x.rule)):
        rule_host, _, rest = r.rule.partition("/")
        fits = (((host == rule_host) | host.endswith("." + rule_host))
                & path.startswith("/" + rest))
        rule = F.when(fits, F.lit(r.rule)).otherwise(rule)
        verdict = F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return rule, verdict


def _grams(part: Column, tag: str, n: int, dimensions: int) -> Column:
    framed = F.concat(F.lit("^"), part, F.lit("$"))
    starts = F.sequence(F.lit(1), F.greatest(F.length(framed) - n + 1, F.lit(1)))
    return F.transform(starts, lambda i: F.pmod(
        F.xxhash64(F.concat(F.lit(tag), framed.substr(i, F.lit(n)))), F.lit(dimensions)).cast("int"))


def feature_ids(host: Column, path: Column, dimensions: int = DIMENSIONS) -> Column:
    """Distinct hashed n-grams of host and path (each kind hashed apart)."""
    return F.array_distinct(F.concat(*[_grams(part, f"{tag}{n}:", n, dimensions)
                                       for tag, part in (("h", host), ("p", path))
                                       for n in NGRAMS]))


class UrlModel(NamedTuple):
    weights: list[float]
    intercept: float

    def score(self, features: Column) -> Column:
        """Probability of "block"."""
        # a constant of the plan, folded once
        w = F.split(F.lit(",".join(map(repr, self.weights))), ",").cast("array<double>")
        total = F.aggregate(features, F.lit(0.0),
                            lambda acc, i: acc + F.element_at(w, i + F.lit(1)))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-(total + F.lit(self.intercept))))


def train(labelled: DataFrame, dimensions: int = DIMENSIONS, reg: float = 0.001) -> UrlModel:
    """Fit the regression on a small labelled table (``url``, ``label``)."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import array_to_vector
    f = with_host_and_path(labelled).select(
        "label", feature_ids(F.col("_host"), F.col("_path"), dimensions).alias("ids"))
    dense = F.transform(F.sequence(F.lit(0), F.lit(dimensions - 1)),
                        lambda j: F.array_contains(F.col("ids"), j).cast("double"))
    rows = f.select("label", array_to_vector(dense).alias("features")).persist()
    try:
        model = LogisticRegression(regParam=reg, maxIter=50, standardization=False).fit(rows)
    finally:
        rows.unpersist()
    return UrlModel([float(x) for x in model.coefficients.toArray()], float(model.intercept))


def judge_urls(df: DataFrame, rules: Sequence[Rule], model: UrlModel, *, url: str = "url",
               threshold: float = 0.2) -> DataFrame:
    """``threshold``: the labelled table holds far more unwanted sites than
    the web does, so the cut is low; ordinary URLs score below 0.1.

    Returns ``row`` (a struct of the input's columns, so no name can
    clash), ``host``, ``path``, ``rule``, ``verdict`` (allow or block: the
    rule's, else the model's) and ``block_score``.

    A null URL, or one without ``://``, has empty host and path: no rule
    fits it and the model judges the empty strings.  Repeated rows are
    judged alike; no rows give no rows.
    """
    rule, by_rule = rule_columns(F.col("_host"), F.col("_path"), rules)
    score = model.score(feature_ids(F.col("_host"), F.col("_path"), len(model.weights)))
    return (with_host_and_path(df.select(F.struct("*").alias("row"),
                                         F.col(f"`{url}`").alias("_in")), "_in")
            .withColumn("_score", score)
            .select("row", F.col("_host").alias("host"), F.col("_path").alias("path"),
                    rule.alias("rule"),
                    F.coalesce(by_rule, F.when(F.col("_score") >= threshold, "block")
                               .otherwise("allow")).alias("verdict"),
                    F.col("_score").alias("block_score")))
