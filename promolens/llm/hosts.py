"""URL filters: rules by host and path, and host reputation by empirical Bayes.

Labelled page outcomes are shrunk through beta-binomial priors from the whole table to the public
suffix, the registered domain and the host; a host is blocked when the lower posterior bound of
its share of bad pages is above a limit.
"""

from __future__ import annotations

import html
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promolens.llm.common import arrow_batches, hot_join, map_rows, materialise

#: (host, path, verdict): a rule fits its host and all subdomains where the url's path starts with its path.
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
#: A host is blocked when its share of bad pages is above MOST_BAD with this probability.
MOST_BAD, CERTAINTY = 0.5, 0.95
#: Strengths of a prior, in pages, that the fit chooses from.
STRENGTHS = 2.0 ** np.arange(0, 12.5, 0.5)
#: Second-level names under which countries register domains.
SECOND_LEVEL = ("ac", "co", "com", "edu", "gov", "net", "org")
URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
BLANKS = r"[\x00-\x20\x85\xA0\u2000-\u200B\u3000]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, URL, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, URL, 2), F.lit(""))


def longest_rule(host: Column, path: Column, rules=RULES) -> Column:
    """struct(rule, verdict) of the longest rule that fits, else null; rules of equal length: the one given first."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for name, at, verdict in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(at)
        out = F.when(fits, F.struct(F.lit(name + at).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def domain_parts(host: Column) -> tuple[Column, Column]:
    """(registered domain, public suffix) of a host, whatever user, port or closing dot it bears; an address is its own."""
    bare = F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r"\.?(:\d*)?$", "")
    labels = F.split(bare, r"\.")
    country = (F.length(F.element_at(labels, -1)) == 2) & (F.size(labels) > 2) & F.try_element_at(labels, F.lit(-2)).isin(*SECOND_LEVEL)
    last = lambda n: F.array_join(F.slice(labels, -F.least(F.size(labels), n), F.least(F.size(labels), n)), ".")
    suffix = F.when(country, F.lit(2)).otherwise(F.lit(1))
    address = bare.rlike(r"^([0-9.]+|\[.*)$")
    return F.when(address, bare).otherwise(last(suffix + 1)), F.when(address, bare).otherwise(last(suffix))


def article_text(page: str) -> str:
    """The text of a page's article, or of the page where it has none, without its heading and any blanks."""
    low = page.find("<article")
    if low >= 0:
        page = page[low : max(page.find("</article>", low), low) if "</article>" in page[low:] else None]
    parts = page.partition("<h1")
    if parts[1]:
        page = parts[0] + parts[2].partition("</h1>")[2]
    return re.sub(BLANKS, "", html.unescape(re.sub(r"<[^<>]*>", "", page)))


def text_digest(text: Column) -> Column:
    """md5 of a text without blanks; null where nothing is left."""
    bare = F.regexp_replace(text, BLANKS, "")
    return F.when(bare != "", F.md5(bare))


def with_digests(pages: DataFrame) -> DataFrame:
    """page_id, url and the digest of each page's article."""

    def run(rows):
        return {"page_id": rows["page_id"], "url": rows["url"], "bare": [article_text(x or "") for x in rows["html"]]}

    chosen = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return map_rows(chosen, run, "page_id long,url string,bare string").select("page_id", "url", text_digest(F.col("bare")).alias("digest"))


def text_outcomes(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(digest, bad) of each labelled text: bad where any copy's label says low quality or toxic."""
    said = F.when(F.col("quality").isNotNull() | F.col("toxic").isNotNull(), (F.coalesce("quality", F.lit(1)) == 0) | (F.coalesce("toxic", F.lit(0)) == 1))
    known = labels.select("doc_id", said.alias("bad")).where("doc_id is not null and bad is not null").groupBy("doc_id").agg(F.max("bad").alias("bad"))
    texts = docs.select("doc_id", text_digest(F.col("text")).alias("digest")).where("doc_id is not null and digest is not null").distinct()
    return texts.join(known, "doc_id").groupBy("digest").agg(F.max("bad").alias("bad"))


# --- beta-binomial arithmetic, vectorised ---


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series from 10 up, steps of the recurrence below."""
    x = np.asarray(x, float)
    step = np.ones_like(x)
    small = x < 10
    while small.any():
        step[small] *= x[small]
        x = np.where(small, x + 1, x)
        small = x < 10
    return (x - 0.5) * np.log(x) - x + 0.9189385332046727 + 1 / (12 * x) - 1 / (360 * x**3) + 1 / (1260 * x**5) - 1 / (1680 * x**7) - np.log(step)


def log_beta(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return log_gamma(a) + log_gamma(b) - log_gamma(a + b)


def beta_below(x: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Probability that a beta variable is at most x: the continued fraction of the incomplete beta function."""
    x, a, b = np.broadcast_arrays(np.asarray(x, float), a, b)
    swap = x > (a + 1) / (a + b + 2)  # the fraction converges fast below the mean
    x, a, b = np.where(swap, 1 - x, x), np.where(swap, b, a), np.where(swap, a, b)
    tiny = 1e-300
    away = lambda v: np.where(np.abs(v) < tiny, tiny, v)
    c, d = np.ones_like(x), 1 / away(1 - (a + b) * x / (a + 1))
    out = d.copy()
    for m in range(1, 2000):
        for top in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d, c = 1 / away(1 + top * d), away(1 + top / c)
            out = out * d * c
        if np.all(np.abs(d * c - 1) < 1e-12):
            break
    with np.errstate(divide="ignore"):
        out = np.exp(a * np.log(x) + b * np.log1p(-x) - log_beta(a, b)) * out / a
    return np.where(swap, 1 - out, out)


def lower_bound(a: np.ndarray, b: np.ndarray, certainty: float) -> np.ndarray:
    """What a beta variable exceeds with this probability, by halving."""
    low, high = np.zeros(len(a)), np.ones(len(a))
    for _ in range(50):
        middle = (low + high) / 2
        over = beta_below(middle, a, b) > 1 - certainty
        low, high = np.where(over, low, middle), np.where(over, middle, high)
    return low


def fit_strength(groups: DataFrame) -> float:
    """The prior's strength that makes (pages, bad) of all groups likeliest, given each one's prior mean.

    Likelihoods of all STRENGTHS are summed in the tasks, so that many numbers reach the driver. A
    group that is all of its parent says nothing about how groups differ, and is left out; without
    any other the strongest prior holds.
    """
    arrow_batches(groups.sparkSession)

    def run(batches):
        total = np.zeros(STRENGTHS.size)
        for batch in batches:
            if batch.num_rows:
                n, bad, mean = (batch.column(c).to_numpy().astype(float)[:, None] for c in ("pages", "bad", "mean"))
                a, b = mean * STRENGTHS, (1 - mean) * STRENGTHS
                total += (log_beta(a + bad, b + n - bad) - log_beta(a, b)).sum(0)
        yield pa.RecordBatch.from_arrays([pa.array(range(total.size), pa.int32()), pa.array(total)], ["k", "likelihood"])

    informed = groups.where("pages > 0 and pages < parent_pages").select("pages", "bad", "mean")
    sums = informed.mapInArrow(run, "k int, likelihood double").groupBy("k").agg(F.round(F.sum("likelihood"), 6).alias("likelihood")).collect()  # a row a strength
    return float(STRENGTHS[max(((r["likelihood"], r["k"]) for r in sums), default=(0, STRENGTHS.size - 1))[1]])


def shrink(groups: DataFrame, strength: float) -> DataFrame:
    """Beta posterior (a, b) of each group's share of bad pages under its parent's mean."""
    a = F.col("bad") + strength * F.col("mean")
    return groups.withColumn("a", a).withColumn("b", F.col("pages") + strength - a)


def host_reputation(trials: DataFrame, certainty: float = CERTAINTY) -> DataFrame:
    """(host, pages, bad) of all hosts to host, pages, bad, a, b and bound.

    Counts add up to the domain and the suffix; from the top down each level's posterior mean is
    the prior mean of the next, with the strength that fits the level. Hosts without labelled
    pages have their domain's prior; no host at all ('') has the whole table's.
    """
    domain, suffix = domain_parts(F.col("host"))
    hosts = materialise(trials.select("host", "pages", "bad", domain.alias("domain"), suffix.alias("suffix")), "host-counts")
    add = [F.sum("pages").alias("pages"), F.sum("bad").alias("bad")]
    domains = materialise(hosts.groupBy("domain", "suffix").agg(*add), "domain-counts")
    suffixes = materialise(domains.groupBy("suffix").agg(*add), "suffix-counts")
    pages, bad = suffixes.agg(F.coalesce(F.sum("pages"), F.lit(0)), F.coalesce(F.sum("bad"), F.lit(0))).first()
    level = suffixes.withColumn("mean", F.lit((bad + 0.5) / (pages + 1))).withColumn("parent_pages", F.lit(pages))
    for name, below in (("suffix", domains), ("domain", hosts)):
        known = shrink(level, fit_strength(level)).select(name, (F.col("a") / (F.col("a") + F.col("b"))).alias("mean"), F.col("pages").alias("parent_pages"))
        level = materialise(hot_join(below, known, name), f"host-prior-{name}")
    found = shrink(level, fit_strength(level)).select("host", "pages", "bad", "a", "b")

    def run(rows):
        return rows | {"bound": lower_bound(np.array(rows["a"]), np.array(rows["b"]), certainty)}

    return map_rows(found, run, "host string,pages long,bad long,a double,b double,bound double")


def judge_urls(pages: DataFrame, docs: DataFrame, labels: DataFrame, rules=RULES, most_bad: float = MOST_BAD, certainty: float = CERTAINTY) -> DataFrame:
    """Operator: page_id, host, path, rule, verdict, and the host's outcomes, posterior mean and bound, of each page.

    A page's outcome is the label of the documents with its article's text; pages of one host
    with one text are one outcome. The longest rule decides; without one a page is blocked if its
    host's bound is above ``most_bad``. Null urls and ones without ``://`` have an empty host and
    path and no rule; null html has no outcome; repeated rows are judged alike; an empty table
    gives no rows, empty labels leave all to the rules and the prior. Rules are a plan's constants:
    tens, not millions.
    """
    read = with_digests(pages)
    parts = read.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), "digest")
    parts = materialise(parts, "url-parts")
    found = materialise(parts.where("digest is not null").select("host", "digest").distinct(), "url-texts")
    met = hot_join(found, materialise(text_outcomes(docs, labels), "url-outcomes"), "digest")
    counted = met.select("host", F.lit(1).alias("pages"), F.col("bad").cast("long").alias("bad")).unionByName(parts.select("host", F.lit(0).alias("pages"), F.lit(0).cast("long").alias("bad")))
    trials = counted.groupBy("host").agg(F.sum("pages").alias("pages"), F.sum("bad").alias("bad"))
    known = materialise(host_reputation(trials, certainty).select("host", F.col("pages").alias("host_pages"), F.col("bad").alias("host_bad"), (F.col("a") / (F.col("a") + F.col("b"))).alias("bad_share"), "bound"), "url-hosts")
    rule = longest_rule(F.col("host"), F.col("path"), rules)
    verdict = F.coalesce(rule["verdict"], F.when(F.col("bound") > most_bad, "block").otherwise("allow"))
    judged = hot_join(parts.drop("digest"), known, "host")
    return judged.select("page_id", "host", "path", rule["rule"].alias("rule"), verdict.alias("verdict"), "host_pages", "host_bad", F.round("bad_share", 6).alias("bad_share"), F.round("bound", 6).alias("bound"))
