"""URL filters: rules first, then an empirical-Bayes reputation of the host.

Labelled outcomes (good or not) are counted per host.  The share of good pages
of a host has a beta prior around the estimate of its registered domain, that one
around its suffix, and that one around the corpus; the strength of each prior
comes from how much siblings differ (the intraclass correlation of a
beta-binomial model).  A host is blocked when the upper posterior bound of its
share lies under a minimum.  For that bound a prior counts as few outcomes at most,
however strongly it draws the estimate: where siblings hardly differ, what is
uncertain is the parents' estimate itself.  So a host without evidence passes unless
its parents are far below the minimum.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from qirtas.llm import common
from qirtas.operators.skew import join_lookup
from qirtas.storage import materialize

# Fixed values: (rule, verdict) and suffixes under which names are registered.
RULES = (
    ("net/", "block"),
    ("example.net/en/", "allow"),
    ("example.com/de/", "block"),
    ("org/fr/", "allow"),
)
SECOND_LEVEL = r"(?:ac|co|com|edu|gov|net|org)\.(?:ar|au|br|cn|hk|id|il|in|jp|kr|mx|nz|sg|th|tr|tw|uk|za)"
# Numeric addresses are their own domain and suffix.
ADDRESS = r"^(?:[0-9]+(?:\.[0-9]+){3}|\[.*\])$"
USER, PORT = r"^.*@", r":[0-9]*$"
DOMAIN = rf"(?:^|\.)((?:[^.]+\.)?(?:{SECOND_LEVEL}|[^.]+))$"
SUFFIX = rf"(?:^|\.)({SECOND_LEVEL}|[^.]+)$"

MAX_RULES = 1_000
MIN_GOOD = 0.8
Z = 1.6448536269514722
WEAKEST, STRONGEST = 1.0, 1_000.0
CERTAIN = 20.0  # outcomes that a prior is worth at most in the bound
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: str) -> Column:
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, UPPER, LOWER), F.lit(""))


def path_of(url: str) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def matching_rule(rules: Sequence[tuple[str, str]], host: str, path: str) -> Column:
    """The longest rule that fits, as a struct (rule, verdict); null if none does."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules")
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule, verdict in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        name, slash, rest = rule.partition("/")
        fits = (F.col(host) == name) | F.col(host).endswith("." + name)
        fits = fits & F.col(path).startswith(slash + rest)
        chosen = F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))
        found = F.when(fits, chosen).otherwise(found)
    return found


def prior_strength(children: DataFrame, parent: str) -> DataFrame:
    """One row: how many outcomes the parent's estimate is worth for a child.

    The least where no two siblings have outcomes, or none has two.
    """
    per_parent = (
        children.filter("n > 0")
        .groupBy(parent)
        .agg(
            F.count("*").alias("k"),
            F.sum("n").alias("n"),
            F.sum("good").alias("good"),
            F.sum(F.col("n") * F.col("n")).alias("nn"),
            F.sum(F.col("good") * F.col("good") / F.col("n")).alias("gg"),
        )
    )
    sums = per_parent.agg(
        F.sum("k").alias("k"),
        F.count("*").alias("p"),
        F.sum("n").alias("n"),
        F.sum(F.col("n") - F.col("nn") / F.col("n")).alias("n0"),
        F.sum(F.col("gg") - F.col("good") * F.col("good") / F.col("n")).alias("between"),
        F.sum(F.col("good") - F.col("gg")).alias("within"),
    )
    msb = F.try_divide("between", F.col("k") - F.col("p"))
    msw = F.try_divide("within", F.col("n") - F.col("k"))
    n0 = F.try_divide("n0", F.col("k") - F.col("p"))
    rho = F.try_divide(msb - msw, msb + (n0 - 1) * msw)
    usable = (F.col("k") > F.col("p")) & (F.col("n") > F.col("k"))
    differ = F.when(rho > 1 / (STRONGEST + 1), F.greatest(F.try_divide(F.lit(1.0), rho) - 1, F.lit(WEAKEST)))
    strength = F.when(usable, F.coalesce(differ, F.lit(STRONGEST))).otherwise(WEAKEST)
    return sums.select(strength.alias("strength"))


def shrunk(children: DataFrame, parents: DataFrame, parent: str) -> DataFrame:
    """Posterior mean of each child around its parent's, and the evidence behind it."""
    strength = prior_strength(children, parent)  # one row
    prior = F.col("mean") * F.col("strength")
    return (
        children.join(parents.select(parent, "mean"), parent)
        .crossJoin(F.broadcast(strength))
        .withColumn("weight", F.col("n") + F.col("strength"))
        .withColumn("mean", (F.col("good") + prior) / F.col("weight"))
        .withColumn("certain", F.col("n") + F.least("strength", F.lit(CERTAIN)))
        .drop("strength")
    )


def domain_of(host: str) -> Column:
    """The registered domain of a host, without user part and port; an address as it is."""
    name = F.regexp_replace(F.regexp_replace(host, USER, ""), PORT, "")
    return F.when(name.rlike(ADDRESS), name).otherwise(F.regexp_extract(name, DOMAIN, 1))


def suffix_of(domain: str) -> Column:
    return F.when(F.col(domain).rlike(ADDRESS), F.col(domain)).otherwise(F.regexp_extract(domain, SUFFIX, 1))


def host_reputation(hosts: DataFrame) -> DataFrame:
    """``hosts`` (host, good, n, pages) with mean, weight and weight for the bound of each host's posterior."""
    hosts = hosts.withColumn("domain", domain_of("host"))
    total = lambda df, by: df.groupBy(*by).agg(F.sum("good").alias("good"), F.sum("n").alias("n"))
    domains = total(hosts, ["domain"]).withColumn("suffix", suffix_of("domain"))
    suffixes = total(domains, ["suffix"]).withColumn("root", F.lit(0))
    root = suffixes.groupBy("root").agg(
        ((F.sum("good") + 1) / (F.sum("n") + 2)).alias("mean")
    )
    suffixes = shrunk(suffixes, root, "root")
    domains = shrunk(domains, suffixes, "suffix")
    return shrunk(hosts, domains, "domain")


def judge(
    pages: DataFrame,
    outcomes: DataFrame,
    rules: Sequence[tuple[str, str]] = RULES,
    key: str = "page_id",
    url: str = "url",
    min_good: float = MIN_GOOD,
    z: float = Z,
) -> DataFrame:
    """key, host, path, rule, verdict of each row of ``pages``.

    ``outcomes`` has a page's ``key`` and ``good`` (1 or 0; null says nothing); a page
    with several outcomes counts each.  A null url, or one without ``://``, has the
    empty host, which has a reputation like any other.  Repeated rows and null
    keys are judged each.  Without any outcome nothing but rules can block.  Pages of a frequent host do not move to meet its verdict.
    """
    counted = (
        outcomes.filter(F.col("good").isNotNull())
        .groupBy(F.col(key).alias("_labelled"))
        .agg(F.sum("good").cast("double").alias("good"), F.count("*").cast("double").alias("n"))
    )
    addressed = materialize(
        pages.select(key, host_of(url).alias("host"), path_of(url).alias("path")), "addressed"
    )
    seen = addressed.join(counted, F.col(key) == F.col("_labelled"), "left")
    hosts = seen.groupBy("host").agg(
        F.sum(F.coalesce("good", F.lit(0.0))).alias("good"),
        F.sum(F.coalesce("n", F.lit(0.0))).alias("n"),
        F.count("*").alias("pages"),
    )
    spread = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("certain") + 1))
    blocked = F.col("mean") + z * spread < min_good
    verdicts = host_reputation(materialize(hosts, "hosts")).select(
        "host", "pages", F.when(blocked, "block").otherwise("allow").alias("reputation")
    )
    return (
        join_lookup(addressed, materialize(verdicts, "verdicts"), "host", "pages")
        .withColumn("_rule", matching_rule(rules, "host", "path"))
        .select(
            key,
            "host",
            "path",
            F.col("_rule.rule").alias("rule"),
            F.coalesce("_rule.verdict", "reputation").alias("verdict"),
        )
    )


def op1_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality label with a page's number is taken as the outcome of that page."""
    labels = common.table(spark, sf_dir, "labels")
    outcomes = labels.select(F.col("doc_id").alias("page_id"), F.col("quality").alias("good"))
    return judge(common.table(spark, sf_dir, "pages"), outcomes)


def _level(child: str, parent: str, above: str) -> str:
    """SQL of one level of shrinking."""
    return f"""
{child}_parents AS (SELECT {parent}, count(*) AS k, sum(n) AS n, sum(good) AS good, sum(n * n) AS nn,
    sum(good * good / n) AS gg FROM {child}s WHERE n > 0 GROUP BY {parent}),
{child}_sums AS (SELECT sum(k) AS k, count(*) AS p, sum(n) AS n, sum(n - nn / n) AS n0,
    sum(gg - good * good / n) AS between_, sum(good - gg) AS within FROM {child}_parents),
{child}_means AS (SELECT CASE WHEN k > p AND n > k THEN between_ / (k - p) END AS msb,
    CASE WHEN k > p AND n > k THEN within / (n - k) END AS msw,
    CASE WHEN k > p THEN n0 / (k - p) END AS n0 FROM {child}_sums),
{child}_rho AS (SELECT (msb - msw) / nullif(msb + (n0 - 1) * msw, 0) AS rho FROM {child}_means),
{child}_strength AS (SELECT CASE WHEN k > p AND n > k THEN coalesce(CASE WHEN rho > {1 / (STRONGEST + 1)!r}
    THEN greatest(1 / rho - 1, {WEAKEST}) END, {STRONGEST}) ELSE {WEAKEST} END AS strength
    FROM {child}_rho CROSS JOIN (SELECT k, p, n FROM {child}_sums)),
{child}_posterior AS (SELECT c.*, c.n + least(strength, {CERTAIN}) AS certain,
    (c.good + mean * strength) / (c.n + strength) AS mean
    FROM {child}s c JOIN {above} USING ({parent}) CROSS JOIN {child}_strength)"""


SQL = rf"""
WITH addressed AS (
    SELECT page_id, coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), '{UPPER}', '{LOWER}'), '') AS host,
        coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
named AS (SELECT *, regexp_replace(regexp_replace(host, '{USER}', ''), '{PORT}', '') AS name FROM addressed),
hosts AS (SELECT host, any_value(CASE WHEN regexp_matches(name, '{ADDRESS}') THEN name ELSE regexp_extract(name, '{DOMAIN}', 1) END) AS domain,
    coalesce(sum(quality), 0)::DOUBLE AS good, count(quality)::DOUBLE AS n
    FROM named LEFT JOIN labels ON doc_id = page_id GROUP BY host),
domains AS (SELECT domain, CASE WHEN regexp_matches(domain, '{ADDRESS}') THEN domain ELSE regexp_extract(domain, '{SUFFIX}', 1) END AS suffix, sum(good) AS good, sum(n) AS n
    FROM hosts GROUP BY domain),
suffixs AS (SELECT suffix, 0 AS root, sum(good) AS good, sum(n) AS n FROM domains GROUP BY suffix),
top AS (SELECT root, (sum(good) + 1) / (sum(n) + 2) AS mean FROM suffixs GROUP BY root),
{_level("suffix", "root", "top").strip()},
{_level("domain", "suffix", "(SELECT suffix, mean FROM suffix_posterior)").strip()},
{_level("host", "domain", "(SELECT domain, mean FROM domain_posterior)").strip()},
ruled AS (SELECT page_id, host, path, CASE
    WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule
    FROM addressed)
SELECT page_id, host, path, rule, CASE rule
    WHEN 'net/' THEN 'block' WHEN 'example.net/en/' THEN 'allow'
    WHEN 'example.com/de/' THEN 'block' WHEN 'org/fr/' THEN 'allow'
    ELSE CASE WHEN mean + {Z!r} * sqrt(mean * (1 - mean) / (certain + 1)) < {MIN_GOOD} THEN 'block' ELSE 'allow' END
    END AS verdict
FROM ruled JOIN host_posterior USING (host)
"""
