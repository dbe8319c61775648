"""URL filter by empirical-Bayes host reputation and longest-match rules, DataFrame functions only.

Labelled outcomes are summed by host. Each level's rates are shrunk towards the level above: a registered domain's posterior
is the prior mean of its hosts, a suffix's that of its domains, the overall rate that of the suffixes. The prior's
strength at each level is fitted by the method of moments over the units of that level. A host is blocked
when the lower bound of its posterior bad rate is above the threshold, so few outcomes never block.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import attach, lower_ascii
from tidemark.storage import materialize

#: Suffixes of two labels that count as one; every other suffix is the last label.
SECOND_LEVEL = ("co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "net.au", "org.au", "co.jp", "ne.jp", "or.jp", "co.nz", "com.br", "com.cn", "com.mx", "co.in", "co.kr", "co.za")
MIN_STRENGTH, MAX_STRENGTH = 2.0, 1000.0
#: Good and bad outcomes that the overall rate starts from.
TOP_PRIOR = 5.0


@dataclass(frozen=True)
class Rule:
    action: str
    host: str
    path: str


def host_of(url: Column) -> Column:
    """Between the first ``://`` and ``/``, ``?``, ``#`` or the end, A-Z lowered; empty if null or without ``://``."""
    return F.coalesce(lower_ascii(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end; empty if null or without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def suffix_of(host: Column) -> Column:
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(*SECOND_LEVEL), two).otherwise(F.substring_index(host, ".", -1))


def domain_of(host: Column) -> Column:
    return F.when(F.substring_index(host, ".", -2).isin(*SECOND_LEVEL), F.substring_index(host, ".", -3)).otherwise(F.substring_index(host, ".", -2))


def rule_for(host: Column, path: Column, rules: Iterable[Rule]) -> Column:
    """struct(action, rule) of the longest rule that fits, or null. The list is a parameter of the plan, compiled into it."""
    by_host: dict[str, list[Rule]] = {}
    for r in rules:
        by_host.setdefault(r.host, []).append(r)
    if not by_host:
        return F.lit(None).cast("struct<n:int,rule:string,action:string>")
    fits = [F.struct(F.lit(len(r.host + r.path)).alias("n"), F.lit(r.host + r.path).alias("rule"), F.lit(r.action).alias("action"), F.lit(r.path).alias("path")) for rs in by_host.values() for r in rs]
    names = [F.lit(r.host) for rs in by_host.values() for r in rs]
    entries = F.array(*[F.struct(n.alias("host"), f.alias("rule")) for n, f in zip(names, fits, strict=True)])
    good = F.filter(entries, lambda e: ((e.host == host) | F.endswith(host, F.concat(F.lit("."), e.host))) & F.startswith(path, e.rule.path))
    return F.array_max(F.transform(good, lambda e: F.struct(e.rule.n.alias("n"), e.rule.rule.alias("rule"), e.rule.action.alias("action"))))


def _shrunk(units: DataFrame, parents: DataFrame, parent: str) -> DataFrame:
    """units (name, parent, n, bad, ...) with mean, strength from their parents (name, mean, strength): adds posterior alpha, beta and mean."""
    up = parents.select(F.col("name").alias("up"), F.col("post").alias("prior"), "strength")
    rows = units.join(up, F.col(parent) == F.col("up"))
    a = F.col("bad") + F.col("prior") * F.col("strength")
    b = F.col("n") - F.col("bad") + (1 - F.col("prior")) * F.col("strength")
    return rows.select(*units.columns, a.alias("a"), b.alias("b"), (a / (a + b)).alias("post"))


def _strength(units: DataFrame, parent: str) -> DataFrame:
    """Prior strength of each parent by the method of moments over its units: p (1 - p) over the variance between units beyond binomial noise, less 1."""
    sums = units.groupBy(parent).agg(F.count("*").alias("m"), F.sum("n").alias("n"), F.sum("bad").alias("bad"), F.sum(F.col("n").cast("double") * F.col("n")).alias("nn"), F.sum(F.col("bad").cast("double") * F.col("bad") / F.col("n")).alias("q"))
    p = F.col("bad") / F.col("n")
    within = p * (1 - p)
    # One unit, or no spread to fit it from, gives 10. Weighted variance between units: E[sum n (r - p)^2] = (m - 1) within + (n - nn / n) between
    between = (F.col("q") - F.col("bad") * p - (F.col("m") - 1) * within) / (F.col("n") - F.col("nn") / F.col("n"))
    k = F.when((F.col("m") < 2) | (within <= 0), F.lit(10.0)).when(between <= 0, F.lit(MAX_STRENGTH)).otherwise(F.greatest(F.lit(MIN_STRENGTH), F.least(F.lit(MAX_STRENGTH), within / between - 1)))
    return sums.select(F.col(parent).alias("name"), "n", "bad", k.cast("double").alias("strength"))


def _bound(z: float) -> Column:
    a, b = F.col("a"), F.col("b")
    return a / (a + b) - z * F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))


def _levels(counts: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Hosts with outcomes, and the priors (name, post, strength) that domains, suffixes and the overall rate give to what is below them."""
    hosts = counts.select(F.col("host").alias("name"), domain_of(F.col("host")).alias("domain"), suffix_of(F.col("host")).alias("suffix"), "n", "bad")
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).withColumn("top", F.lit(""))
    top = _strength(suffixes, "top").withColumn("post", (F.col("bad") + TOP_PRIOR) / (F.col("n") + 2 * TOP_PRIOR))
    in_suffix = _shrunk(suffixes.select(F.col("suffix").alias("name"), "top", "n", "bad"), top, "top").join(_strength(domains, "suffix").select("name", "strength"), "name")
    in_domain = _shrunk(domains.select(F.col("domain").alias("name"), "suffix", "n", "bad"), in_suffix, "suffix").join(_strength(hosts, "domain").select("name", "strength"), "name")
    return hosts, in_domain, in_suffix, top


def posterior(hosts: DataFrame, counts: DataFrame, z: float = 1.645) -> DataFrame:
    """hosts: (host, ...), one row each. counts: (host, n, bad) of labelled pages. Adds outcomes, bad, post (posterior bad rate) and lower (its bound).

    A host's prior is its domain's posterior, where no labelled page knows the domain the suffix's, else the overall rate; a host without outcomes is left with it. The
    empty host has no name to judge by, and without any outcome nothing has: null.
    """
    known, *levels = _levels(counts.where("host <> ''"))
    rows = hosts.join(known.select(F.col("name").alias("h"), F.col("n").alias("known_n"), F.col("bad").alias("known_bad")), F.col("host") == F.col("h"), "left")
    for name, key, prior in zip("dst", (domain_of(F.col("host")), suffix_of(F.col("host")), F.lit("")), levels, strict=True):
        up = prior.select(F.col("name").alias(name), F.struct("post", "strength").alias(f"{name}_prior"))
        rows = rows.join(up, key == F.col(name), "left")
    prior = F.when(F.col("host") != "", F.coalesce("d_prior", "s_prior", "t_prior"))
    rows = rows.select(*hosts.columns, prior.alias("prior"), F.coalesce("known_n", F.lit(0)).alias("outcomes"), F.coalesce("known_bad", F.lit(0)).alias("bad"))
    rows = rows.withColumns({"a": F.col("bad") + F.col("prior.post") * F.col("prior.strength"), "b": F.col("outcomes") - F.col("bad") + (1 - F.col("prior.post")) * F.col("prior.strength")})
    return rows.select(*hosts.columns, "outcomes", "bad", (F.col("a") / (F.col("a") + F.col("b"))).alias("post"), _bound(z).alias("lower"))


def reputation(outcomes: DataFrame, z: float = 1.645) -> DataFrame:
    """outcomes: (host, bad 0/1), null bad counts as no outcome. Per host with outcomes: host, outcomes, bad, post, lower as in ``posterior``."""
    counts = outcomes.where("bad is not null").groupBy("host").agg(F.count("*").alias("n"), F.sum(F.col("bad").cast("long")).alias("bad"))
    return posterior(counts.select("host"), counts, z)


def judge(pages: DataFrame, outcomes: DataFrame, rules: Iterable[Rule] = (), key: str = "page_id", url: str = "url", threshold: float = 0.5, z: float = 1.645) -> DataFrame:
    """One row per page: (key, host, path, rule, verdict). A fitting rule decides; else the host's posterior bound; a host without outcomes has that of its domain, suffix or the overall rate.

    outcomes: (key, bad) labelled pages; several outcomes of one key count as bad if any is. Null url: empty host and path, allowed unless
    a rule fits. Repeated pages come back repeated; null keys stay and never meet an outcome. Empty tables are fine.
    Pages are counted by key and host before they meet outcomes, and hosts with many pages meet their verdict where the pages are, so neither a hot host nor a hot key fills a task.
    """
    named = pages.select(F.col(key).alias("k"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    known = outcomes.where("bad is not null").groupBy(F.col(key).alias("ok")).agg(F.max("bad").cast("long").alias("bad"))
    seen = named.where("k is not null").groupBy("k", "host").agg(F.count("*").alias("n"))
    counts = materialize(seen.join(known, F.col("k") == F.col("ok")).groupBy("host").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("bad")).alias("bad")), "outcomes")
    hosts = posterior(named.groupBy("host").agg(F.count("*").alias("n")), counts, z)
    verdicts = materialize(hosts.select("host", "n", F.when(F.col("lower") > threshold, "block").otherwise("allow").alias("judged")), "verdicts")
    rows = attach(named, verdicts, "host").withColumn("r", rule_for(F.col("host"), F.col("path"), rules))
    return rows.select(F.col("k").alias(key), "host", "path", F.col("r.rule").alias("rule"), F.coalesce(F.col("r.action"), F.col("judged")).alias("verdict"))
