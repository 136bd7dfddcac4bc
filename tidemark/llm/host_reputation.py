"""URL filter: allow and block rules, then an empirical-Bayes reputation of the host.

Only DataFrame functions. The good share of a host's labelled pages is shrunk
to its registered domain's, that to its suffix's, and that to the corpus', each
by a beta-binomial prior whose strength is the spread found at that level.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: A host is blocked if its good share is below the floor even at the posterior's upper bound.
FLOOR = 0.5
#: Standard deviations of the posterior between mean and bound.
DEVIATIONS = 1.645
#: Limits of a prior's strength, in pages.
WEAKEST, STRONGEST = 1.0, 10_000.0


@dataclass(frozen=True)
class UrlRule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """Text after the first ``://`` up to ``/ ? #`` or the end, A-Z lower-cased; empty for null or without ``://``."""
    after = F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1)
    return F.coalesce(F.translate(after, UPPER, UPPER.lower()), F.lit(""))


def path_of(url: Column) -> Column:
    """Text after the host up to ``? #`` or the end; empty for null or without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: list[UrlRule]) -> Column:
    """The longest rule that fits as ``struct(name, verdict)``, or null. For tens of rules, tried in turn."""
    out = F.lit(None).cast("struct<name:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = ((host == rule.host) | F.endswith(host, F.lit(f".{rule.host}"))) & F.startswith(path, F.lit(rule.path))
        out = F.when(fits, F.struct(F.lit(rule.name).alias("name"), F.lit(rule.verdict).alias("verdict"))).otherwise(out)
    return out


def suffix_of(host: Column, second_level: tuple[str, ...] = ()) -> Column:
    """Last label of a host, or its last two where they are listed as a suffix (such as ``co.uk``)."""
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(*second_level), two).otherwise(F.substring_index(host, ".", -1)) if second_level else F.substring_index(host, ".", -1)


def domain_of(host: Column, second_level: tuple[str, ...] = ()) -> Column:
    """The suffix and one label before it."""
    two, three = F.substring_index(host, ".", -2), F.substring_index(host, ".", -3)
    return F.when(two.isin(*second_level), three).otherwise(two) if second_level else two


def _strength(units: DataFrame) -> DataFrame:
    """One row: the strength (pseudo-pages) that the spread of ``good / n`` over units calls for, by moments."""
    sums = units.where("n > 0").agg(
        F.count("*").cast("double").alias("m"),
        F.sum("n").cast("double").alias("pages"),
        F.sum("good").cast("double").alias("good"),
        F.sum(F.col("n").cast("double") * F.col("n")).alias("nn"),
        F.sum(F.col("good").cast("double") * F.col("good") / F.col("n")).alias("gg"),
    )
    p = "(good / pages)"
    spread = f"(gg - good * {p})"  # sum of n (good/n - p)^2
    within = f"({p} * (1 - {p}))"
    rho = f"(({spread} - {within} * (m - 1)) / ({within} * (pages - nn / pages - (m - 1))))"
    return sums.select(
        F.expr(
            f"case when m > 1 and pages > m and good > 0 and good < pages and pages - nn / pages - (m - 1) > 0 and {rho} > 0 "
            f"then greatest({WEAKEST}D, least({STRONGEST}D, (1 - {rho}) / {rho})) else {STRONGEST}D end"
        ).alias("strength")
    )


def reputations(hosts: DataFrame, second_level: tuple[str, ...] = (), deviations: float = DEVIATIONS) -> DataFrame:
    """``host, n, good, a, b, bound`` from ``host, n, good``, one row a host; ``bound`` is the posterior's upper bound of the good share.

    Strengths and the corpus' share are scalar subqueries.
    """
    host = F.col("host")
    hosts = hosts.select("host", "n", "good", domain_of(host, second_level).alias("domain"), suffix_of(host, second_level).alias("suffix"))
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    corpus = suffixes.agg(((F.sum("good") + 1.0) / (F.sum("n") + 2.0)).alias("prior"))

    mean = (F.col("good") + F.col("strength") * F.col("prior")) / (F.col("n") + F.col("strength"))
    suffix_means = suffixes.withColumns({"prior": corpus.scalar(), "strength": _strength(suffixes).scalar()}).select("suffix", mean.alias("prior"))
    domain_means = domains.join(suffix_means, "suffix").withColumn("strength", _strength(domains).scalar()).select("domain", mean.alias("prior"))
    a = F.col("good") + F.col("strength") * F.col("prior")
    b = F.col("n") - F.col("good") + F.col("strength") * (1 - F.col("prior"))
    rows = hosts.join(domain_means, "domain").withColumn("strength", _strength(hosts).scalar())
    rows = rows.select("host", "n", "good", a.alias("a"), b.alias("b"))
    share = F.col("a") / (F.col("a") + F.col("b"))
    deviation = F.sqrt(share * (1 - share) / (F.col("a") + F.col("b") + 1))
    return rows.withColumn("bound", share + deviations * deviation)


def judge_urls(
    pages: DataFrame,
    outcomes: DataFrame,
    rules: list[UrlRule],
    second_level: tuple[str, ...] = (),
    floor: float = FLOOR,
    deviations: float = DEVIATIONS,
) -> DataFrame:
    """``page_id, host, path, rule, verdict`` of every row of ``pages``.

    ``outcomes`` (``page_id, good`` 0 or 1) are the labelled pages; a page's
    labels count once, as good if all are. A rule's verdict goes first;
    elsewhere a page is blocked where the upper posterior bound of its host's
    good share is below ``floor``: doubt allows. A null url or one without
    ``://`` has an empty host and path, fits no rule, and is judged as the host
    "". Null labels and ids without a page are ignored, a null ``page_id`` has
    no label, repeated rows are judged each (and their label counts for each),
    other columns are ignored, an empty table gives an empty result.
    """
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    labelled = outcomes.where("page_id is not null and good is not null").groupBy(F.col("page_id").cast("bigint").alias("l_id")).agg(F.min("good").alias("good"))
    hosts = (
        rows.select("page_id", "host")
        .join(labelled, F.col("page_id") == F.col("l_id"), "left")
        .groupBy("host")
        .agg(F.count("good").alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"))
    )
    bounds = reputations(hosts, second_level, deviations).select(F.col("host").alias("r_host"), "bound")
    found = rows.join(bounds, F.col("host") == F.col("r_host"), "left").withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    own = F.when(F.col("bound") < floor, F.lit("block")).otherwise(F.lit("allow"))
    return found.select("page_id", "host", "path", F.col("rule.name").alias("rule"), F.coalesce("rule.verdict", own).alias("verdict"))
