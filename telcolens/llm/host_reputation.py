"""URL filtering by rules and by empirical-Bayes host reputation (DataFrame operations only).

Labelled page outcomes (bad or not) are counted per host. Each level of the hierarchy

    all pages -> suffix (last label) -> registered domain (last two labels) -> host

has beta-binomial posteriors whose prior mean is the parent's posterior mean; the prior's strength (in
pages) is estimated from the data at that level by the method of moments. A host with few or no
labelled pages so takes its domain's reputation, a domain its suffix's. A page is blocked when the
posterior's lower bound for its host's share of bad pages, mean - z * sd, is over a threshold: little
evidence never blocks.

A rule (host, path, verdict) overrides the reputation: it fits its host and all subdomains when the
url's path starts with the rule's path; the longest rule wins.

Nulls: a null url, or one without ``://``, has an empty host and path; all such pages form one host, and
no rule fits it. Pages with a null outcome count as unlabelled. An empty table gives no rows. Repeated
pages give a row each and count each time. Only ``page_id``, ``url`` and the outcome are read, so other
columns may have any name.

Scale: one shuffle joins labels to (page_id, url); counts per host are aggregated before they move, and
all levels above hosts are computed from that aggregate, which is written once. The join back to pages is on the host, pages
on the streamed side, so a host with a third of all pages is split by AQE. Nothing is broadcast by hint.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telcolens.llm.common import ascii_lower, table, written

# (host and path, verdict). Fixed values of the contract.
RULES = (
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
)
URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
# Posterior bound: standard deviations below the mean, and the share of bad pages over which a host is blocked.
BOUND_Z = 1.645
MAX_BAD = 0.5
# Strength of a prior, in pages, where the data say nothing about it, and its range.
NO_STRENGTH, LEAST_STRENGTH, MOST_STRENGTH = 10.0, 1.0, 10000.0


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (after the first ``://`` up to ``/``, ``?``, ``#``; A-Z lower-cased) and path (then up to ``?``, ``#``)."""
    u = F.coalesce(url, F.lit(""))
    return ascii_lower(F.regexp_extract(u, URL, 1)), F.regexp_extract(u, URL, 2)


def fitting_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict (null: none fits)."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, says in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        name, slash, rest = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, says).otherwise(verdict)
    return rule, verdict


def registered_domain(host: Column) -> Column:
    """The last two labels of the host, without user and port."""
    return F.regexp_extract(F.regexp_replace(host, r"^.*@|:[0-9]*$", ""), r"([^.]+\.[^.]+|[^.]*)\.?$", 1)


def suffix(domain: Column) -> Column:
    return F.regexp_extract(domain, r"([^.]*)$", 1)


def with_posterior(children: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """Adds ``mean`` and ``weight`` (labelled pages plus prior strength) to (key, n, k, ...) rows.

    ``parents``: (``key``, parent_n, parent_k, parent_mean). The strength is by moments over all children of the level:
    with r the within-parent correlation of outcomes, strength = 1 / r - 1."""
    c = children.join(parents, key, "left")
    raw = F.col("parent_k") / F.col("parent_n")
    seen = (F.col("n") > 0) & (F.col("parent_n") > F.col("n"))
    spread = raw * (1 - raw)
    moments = c.where(seen).agg(
        F.sum(F.col("n") * F.pow(F.col("k") / F.col("n") - raw, 2)).alias("s"),
        F.sum(spread * (1 - F.col("n") / F.col("parent_n"))).alias("s0"),
        F.sum(spread * (F.col("n") - F.col("n") * F.col("n") / F.col("parent_n"))).alias("s1"),
    )
    r = (F.col("s") - F.col("s0")) / (F.col("s1") - F.col("s0"))
    strength = (
        F.when(F.col("s1").isNull() | (F.col("s1") <= F.col("s0")), NO_STRENGTH)
        .when(r <= 0, MOST_STRENGTH)
        .when(r >= 1, LEAST_STRENGTH)
        .otherwise(F.greatest(F.lit(LEAST_STRENGTH), F.least(F.lit(MOST_STRENGTH), 1 / r - 1)))
    )
    prior = moments.select(strength).head()[0]  # one row
    return (
        c.withColumn("weight", F.col("n") + F.lit(prior))
        .withColumn("mean", (F.col("k") + F.lit(prior) * F.col("parent_mean")) / F.col("weight"))
        .drop("parent_n", "parent_k", "parent_mean")
    )


def host_reputation(pages: DataFrame) -> DataFrame:
    """(host, n, k, mean, weight, lower) from rows (host, bad): bad 1 or 0, null if unlabelled."""
    hosts = written(
        pages.groupBy("host")
        .agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("k"))
        .withColumn("domain", registered_domain(F.col("host")))
        .withColumn("suffix", suffix(F.col("domain")))
        .withColumn("top", F.lit("")),
        "hosts",
    )
    totals = [F.sum("n").alias("n"), F.sum("k").alias("k")]
    domains = hosts.groupBy("domain", "suffix", "top").agg(*totals)
    suffixes = domains.groupBy("suffix", "top").agg(*totals)
    everything = suffixes.groupBy("top").agg(*totals)

    def parent(df: DataFrame, key: str, mean: Column) -> DataFrame:
        return df.select(key, F.col("n").alias("parent_n"), F.col("k").alias("parent_k"), mean.alias("parent_mean"))

    # Without any labelled page the mean is that of one bad and one good page.
    top = parent(everything, "top", (F.col("k") + 1) / (F.col("n") + 2))
    s = with_posterior(suffixes, top, "top")
    d = with_posterior(domains.drop("top"), parent(s, "suffix", F.col("mean")), "suffix")
    h = with_posterior(hosts.drop("top", "suffix"), parent(d, "domain", F.col("mean")), "domain")
    sd = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("weight") + 1))
    return h.select("host", "n", "k", "mean", "weight", (F.col("mean") - BOUND_Z * sd).alias("lower"))


def judge(pages: DataFrame, outcomes: DataFrame, rules: Sequence[tuple[str, str]] = RULES, max_bad: float = MAX_BAD) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, lower (the posterior bound).

    ``pages``: page_id, url; ``outcomes``: page_id, bad (1, 0 or null; of repeated rows the largest counts)."""
    host, path = split_url(F.col("url"))
    p = pages.select("page_id", host.alias("host"), path.alias("path"))
    known = outcomes.where(F.col("page_id").isNotNull()).groupBy("page_id").agg(F.max("bad").alias("bad"))
    rep = host_reputation(p.join(known, "page_id", "left").select("host", F.col("bad").cast("long")))
    rule, says = fitting_rule(F.col("host"), F.col("path"), rules)
    method = F.when(F.col("lower") > max_bad, "block").otherwise("allow")
    return p.join(rep.select("host", "lower"), "host", "left").select(
        "page_id", "host", "path", rule.alias("rule"), F.coalesce(says, method).alias("verdict"), "lower"
    )


def outcomes_of_labels(labels: DataFrame) -> DataFrame:
    """Outcomes of the pages whose id a label row carries: bad if low in quality or toxic."""
    bad = F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).when(
        F.col("quality").isNotNull() | F.col("toxic").isNotNull(), 0
    )
    return labels.select(F.col("doc_id").alias("page_id"), bad.alias("bad"))


def query(spark, sf_dir: str) -> DataFrame:
    """op8: every page's host, path, rule and verdict."""
    out = judge(table(spark, sf_dir, "pages"), outcomes_of_labels(table(spark, sf_dir, "labels")))
    return out.drop("lower")


def _level_sql(name: str, children: str, parents: str, key: str) -> str:
    return f"""
{name}_c AS (SELECT c.*, p.parent_n, p.parent_k, p.parent_mean, p.parent_k / p.parent_n AS raw
  FROM {children} c LEFT JOIN {parents} p USING ({key})),
{name}_m AS (SELECT sum(n * power(k / n - raw, 2)) AS s, sum(raw * (1 - raw) * (1 - n / parent_n)) AS s0,
    sum(raw * (1 - raw) * (n - n * n / parent_n)) AS s1
  FROM {name}_c WHERE n > 0 AND parent_n > n),
{name}_w AS (SELECT CASE WHEN s1 IS NULL OR s1 <= s0 THEN {NO_STRENGTH}
    WHEN s - s0 <= 0 THEN {MOST_STRENGTH} WHEN s >= s1 THEN {LEAST_STRENGTH}
    ELSE greatest({LEAST_STRENGTH}, least({MOST_STRENGTH}, (s1 - s0) / (s - s0) - 1)) END AS strength FROM {name}_m),
{name}_post AS (SELECT c.*, n + strength AS weight, (k + strength * parent_mean) / (n + strength) AS mean
  FROM {name}_c c, {name}_w)"""


def _rules_sql() -> tuple[str, str]:
    rule, says = "NULL", "NULL"
    cases = []
    for text, verdict in sorted(RULES, key=lambda r: (-len(r[0]), r[0])):
        name, slash, rest = text.partition("/")
        cases.append((f"(host = '{name}' OR host LIKE '%.{name}') AND starts_with(path, '{slash + rest}')", text, verdict))
    rule = "CASE " + " ".join(f"WHEN {c} THEN '{t}'" for c, t, _ in cases) + " END"
    says = "CASE " + " ".join(f"WHEN {c} THEN '{v}'" for c, _, v in cases) + " END"
    return rule, says


def sql() -> str:
    rule, says = _rules_sql()
    parent = "n::DOUBLE AS parent_n, k::DOUBLE AS parent_k, mean AS parent_mean"
    return f"""
WITH p AS (SELECT page_id,
    translate(regexp_extract(coalesce(url, ''), '{URL}', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '{URL}', 2) AS path FROM pages),
known AS (SELECT doc_id AS page_id, max(CASE WHEN quality = 0 OR toxic = 1 THEN 1
    WHEN quality IS NOT NULL OR toxic IS NOT NULL THEN 0 END) AS bad FROM labels GROUP BY 1),
hosts AS (SELECT host, count(bad)::DOUBLE AS n, coalesce(sum(bad), 0)::DOUBLE AS k,
    regexp_extract(regexp_replace(host, '^.*@|:[0-9]*$', '', 'g'), '([^.]+\\.[^.]+|[^.]*)\\.?$', 1) AS domain
  FROM p LEFT JOIN known USING (page_id) GROUP BY host),
hosts2 AS (SELECT *, regexp_extract(domain, '([^.]*)$', 1) AS suffix FROM hosts),
domains AS (SELECT domain, suffix, sum(n) AS n, sum(k) AS k FROM hosts2 GROUP BY domain, suffix),
suffixes AS (SELECT suffix, '' AS top, sum(n) AS n, sum(k) AS k FROM domains GROUP BY suffix),
tops AS (SELECT '' AS top, sum(n)::DOUBLE AS parent_n, sum(k)::DOUBLE AS parent_k, (sum(k) + 1) / (sum(n) + 2) AS parent_mean FROM suffixes),
{_level_sql('s', 'suffixes', 'tops', 'top')},
sp AS (SELECT suffix, {parent} FROM s_post),
{_level_sql('d', 'domains', 'sp', 'suffix')},
dp AS (SELECT domain, {parent} FROM d_post),
{_level_sql('h', '(SELECT host, domain, n, k FROM hosts2)', 'dp', 'domain')},
rep AS (SELECT host, mean - {BOUND_Z} * sqrt(mean * (1 - mean) / (weight + 1)) AS lower FROM h_post)
SELECT page_id, host, path, {rule} AS rule,
  coalesce({says}, CASE WHEN lower > {MAX_BAD} THEN 'block' ELSE 'allow' END) AS verdict
FROM p LEFT JOIN rep USING (host)"""
