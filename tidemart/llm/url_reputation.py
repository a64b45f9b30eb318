"""URL filters: written rules first, empirical-Bayes reputation of hosts for the rest.

Labelled outcomes of pages (bad or not) are counted by host. A suffix's rate is shrunk towards the rate of all pages, a
registered domain's towards its suffix, a host's towards its domain: the posterior of each level, without the member's
own counts, is the beta prior of the next. How far members follow their parent is fitted for each level by the method of
moments from the spread of their rates, and a prior is never surer than the counts it comes from. A
host is blocked if even the lower bound of its posterior rate of bad pages is above the limit; hosts without labels take
the posterior of the level above.

Defined cases: a null url, or one without ``://``, has empty host and path; an address of one label is its own domain
and suffix; without labels nothing is blocked by reputation; repeated pages are judged alike; a
table without rows gives none; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.llm.work import lower_ascii, staged

# fixed values: (verdict, host, path)
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
LIMIT, DEVIATIONS = 0.5, 1.64
WEAKEST, STRONGEST = 1.0, 1000.0
# of bad and of good pages, before any label
PRIOR = 0.5


def with_places(pages: DataFrame) -> DataFrame:
    """``page_id, host, path`` of every url."""
    url = F.coalesce(F.col("url"), F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    after = F.substring(rest, F.length(host) + 1, F.length(rest))
    return pages.select(
        "page_id", lower_ascii(host).alias("host"), F.regexp_extract(after, r"^[^?#]*", 0).alias("path")
    )


def longest_rule(rules: Iterable[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The rule that fits best, as text, and its verdict: longest first, so the first that fits."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, host, path in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        own = (F.col("host") == host) | F.col("host").endswith("." + host)
        fits = own & F.col("path").startswith(path)
        name = F.when(fits, F.lit(host + path)).otherwise(name)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return name, verdict


def domain(host: Column) -> Column:
    return F.substring_index(host, ".", -2)


def suffix(host: Column) -> Column:
    return F.substring_index(host, ".", -1)


def strength(children: DataFrame) -> float:
    """How far the members of a level agree with their parents, from rows ``bad, n, mean``.

    Moments of a beta-binomial: the squared distance of a member's rate from its parent's mean exceeds what chance
    explains by mean * (1 - mean) / (strength + 1).
    """
    spread = F.col("mean") * (1 - F.col("mean"))
    distance = (F.col("bad") / F.col("n") - F.col("mean")) ** 2
    sums = children.where("n > 1").agg(
        F.sum(F.col("n") * distance - spread).alias("excess"), F.sum((F.col("n") - 1) * spread).alias("scale")
    )
    row = sums.first()
    if not row.excess or row.excess <= 0:
        return STRONGEST
    return min(max(row.scale / row.excess - 1, WEAKEST), STRONGEST)


def _shrunk(children: DataFrame, *keep: str) -> DataFrame:
    """``keep, a, b``: posteriors of a level's members from ``bad, n`` and their parents' posteriors ``a, b``.

    A member's prior is its parent's posterior without the member's own counts, and no surer than that.
    """
    a, b = F.col("a") - F.col("bad"), F.col("b") - (F.col("n") - F.col("bad"))
    others = children.select(*keep, "bad", "n", (a + b).alias("known"), (a / (a + b)).alias("mean"))
    weight = F.least(F.lit(strength(others)), F.col("known"))
    return others.select(
        *keep,
        (weight * F.col("mean") + F.col("bad")).alias("a"),
        (weight * (1 - F.col("mean")) + F.col("n") - F.col("bad")).alias("b"),
    )


def reputations(hosts: DataFrame) -> DataFrame:
    """``host, a, b``: beta posterior of every host from its counts ``host, bad, n`` (zero where it has no labels)."""
    counted = hosts.withColumn("domain", domain(F.col("host"))).withColumn("suffix", suffix(F.col("host")))
    add = lambda df, *keys: df.groupBy(*keys).agg(F.sum("bad").alias("bad"), F.sum("n").alias("n"))
    domains = add(counted, "domain", "suffix")
    suffixes = add(domains, "suffix")
    total = suffixes.agg(F.sum("bad").alias("bad"), F.sum("n").alias("n")).first()
    bad, good = total.bad or 0, (total.n or 0) - (total.bad or 0)
    every = [F.lit(PRIOR + bad).alias("a"), F.lit(PRIOR + good).alias("b")]
    of_suffix = _shrunk(suffixes.select("*", *every), "suffix")
    of_domain = _shrunk(domains.join(of_suffix, "suffix"), "domain")
    return _shrunk(counted.join(of_domain, "domain"), "host")


def lower_bound(a: Column, b: Column, deviations: float = DEVIATIONS) -> Column:
    """The posterior mean less so many posterior standard deviations."""
    mean, n = a / (a + b), a + b
    return mean - F.lit(deviations) * F.sqrt(mean * (1 - mean) / (n + 1))


def judged(
    pages: DataFrame, outcomes: DataFrame, rules: Iterable[tuple[str, str, str]] = RULES, limit: float = LIMIT
) -> DataFrame:
    """``page_id, host, path, rule, verdict, bad_rate_low`` for every page; ``outcomes`` has ``page_id, bad`` (0 or 1)."""
    placed = with_places(pages)
    known = outcomes.where("bad IS NOT NULL").groupBy("page_id").agg(F.max("bad").alias("bad"))
    # counts of hosts, read by every level
    counts = staged(
        placed.select("page_id", "host")
        .join(known, "page_id", "left")
        .groupBy("host")
        .agg(F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"), F.count("bad").alias("n")),
        "hosts",
    )
    low = reputations(counts).select("host", lower_bound(F.col("a"), F.col("b")).alias("bad_rate_low"))
    name, verdict = longest_rule(rules)
    reputation = F.when(F.col("bad_rate_low") > limit, "block").otherwise("allow")
    return placed.join(low, "host", "left").select(
        "page_id", "host", "path", name.alias("rule"), F.coalesce(verdict, reputation).alias("verdict"), "bad_rate_low"
    )
