"""URL filtering: explicit rules first, empirical-Bayes host reputation for the rest.

Rules are (host, path prefix) pairs; a rule fits its host and all subdomains
where the url's path starts with the rule's, and the longest fitting rule wins.

Reputation: page outcomes (1 bad, 0 good) are counted per host, registered
domain and suffix. Each level's bad rate is shrunk towards its parent's through
a beta prior, root -> suffix -> domain -> host; how strongly is estimated per
level from the spread of its groups (beta-binomial moments). A host is blocked
where the lower bound of its posterior bad rate exceeds ``max_bad``.

Counts combine before the shuffle. Heavy hosts (few by construction, see
``common.heavy_cut``) meet their pages by a broadcast, the others by a shuffle
join, so a host with a third of the pages stays spread over all tasks.

Null urls and urls without ``://`` have an empty host and path, and the
reputation of the empty host. Outcomes of unknown pages count nothing; several
outcomes of one page count each; null outcomes count nothing. Repeated rows are
judged each. With no outcomes at all nothing is blocked by reputation. Only
page_id and url are read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import lower_ascii, spread_join

# Labels that, before a two-letter country, make a suffix under which names are registered
# one label deeper (co.uk, com.br, co.za, ...).
DEEP_LABELS = ("ac", "co", "com", "edu", "gov", "net", "org")


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return f"{self.host}{self.path}"


@dataclass(frozen=True)
class Reputation:
    max_bad: float = 0.5
    z: float = 1.645
    min_strength: float = 1.0
    max_strength: float = 1000.0
    deep_labels: tuple[str, ...] = DEEP_LABELS
    deep_suffixes: tuple[str, ...] = ()  # others of two labels, such as those of hosting services


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path) of a url; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + F.lit(3))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    tail = F.substr(rest, F.char_length(host) + F.lit(1))
    return lower_ascii(host), F.regexp_extract(tail, r"^[^?#]*", 0)


def longest_rule(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """(rule text, verdict) of the longest fitting rule, both null where none fits."""
    text = verdict = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.text), len(r.host), r.text)):  # longer ones override
        fits = ((host == r.host) | F.endswith(host, F.lit("." + r.host))) & F.startswith(path, F.lit(r.path))
        text, verdict = F.when(fits, r.text).otherwise(text), F.when(fits, r.verdict).otherwise(verdict)
    return text, verdict


def host_levels(host: Column, p: Reputation = Reputation()) -> tuple[Column, Column]:
    """(registered domain, suffix) of a host, its port left out. An address is its own domain and suffix.

    A suffix has two labels where the rule of ``deep_labels`` or the list
    ``deep_suffixes`` says so, else one.
    """
    name = F.regexp_replace(host, r":\d*$", "")
    two = F.substring_index(name, ".", -2)
    three = F.substring_index(name, ".", -3)
    is_deep = two.isin(*p.deep_suffixes) | two.rlike(rf"^({'|'.join(p.deep_labels)})\.[a-z]{{2}}$")
    address = name.rlike(r"^[\d.]+$|^\[")
    domain = F.when(address, name).when(is_deep, three).otherwise(two)
    suffix = F.when(address, name).when(is_deep, two).otherwise(F.substring_index(name, ".", -1))
    return domain, suffix


def level_strength(groups: DataFrame, p: Reputation) -> Column:
    """Prior strength of a level (an aggregate over its groups' n and bad), by beta-binomial moments.

    rho = (S / (m (1 - m)) - (G - 1)) / (N - sum n^2 / N - (G - 1)), strength = 1 / rho - 1,
    with m the overall rate and S the weighted squared spread of the groups' rates.
    """
    n, k = F.sum("n").cast("double"), F.sum("bad").cast("double")
    m = k / n
    spread = F.sum(F.col("bad") * F.col("bad") / F.col("n").cast("double")) - k * k / n
    g1 = F.count(F.lit(1)).cast("double") - 1
    scale = n - F.sum(F.col("n") * F.col("n")).cast("double") / n - g1
    rho = F.when((m > 0) & (m < 1) & (scale > 0), (spread / (m * (1 - m)) - g1) / scale).otherwise(F.lit(0.0))
    strength = F.when(rho <= 0, F.lit(p.max_strength)).otherwise(1 / rho - 1)
    return F.least(F.lit(p.max_strength), F.greatest(F.lit(p.min_strength), strength))


def shrink(groups: DataFrame, strength: float, parent_rate: Column) -> Column:
    """Posterior mean bad rate of a group under its parent's rate."""
    return (F.lit(strength) * parent_rate + F.col("bad")) / (F.lit(strength) + F.col("n"))


def host_reputation(pages: DataFrame, outcomes: DataFrame, p: Reputation = Reputation()) -> DataFrame:
    """Per host: host, n_pages, n, bad, rate (posterior mean), lower (posterior bound).

    ``pages`` has (page_id, host), ``outcomes`` (page_id, bad). A label table holds one
    row per page at most, so pages meet outcomes by a shuffle join on the page id.
    """
    seen = outcomes.filter("bad is not null").groupBy("page_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("bad").alias("bad"))
    domain, suffix = host_levels(F.col("host"), p)
    hosts = (pages.join(seen, "page_id", "left").groupBy("host")
             .agg(F.count(F.lit(1)).alias("n_pages"), F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
                  F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
             .withColumn("domain", domain).withColumn("suffix", suffix).checkpoint())
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    # one row of aggregates per level
    root = suffixes.agg(((F.coalesce(F.sum("bad"), F.lit(0)) + 1) / (F.coalesce(F.sum("n"), F.lit(0)) + 2)).alias("m")).first()["m"]
    s_suffix, s_domain, s_host = (t.filter("n > 0").agg(level_strength(t, p).alias("s")).first()["s"] or p.max_strength
                                  for t in (suffixes, domains, hosts))
    suffixes = suffixes.select("suffix", shrink(suffixes, s_suffix, F.lit(root)).alias("suffix_rate"))
    domains = (domains.join(suffixes, "suffix")
               .select("domain", "suffix", shrink(domains, s_domain, F.col("suffix_rate")).alias("domain_rate")))
    both = hosts.join(domains, ["domain", "suffix"])
    a = F.lit(s_host) * F.col("domain_rate") + F.col("bad")
    b = F.lit(s_host) * (1 - F.col("domain_rate")) + F.col("n") - F.col("bad")
    rate = a / (a + b)
    sd = F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))
    return both.select("host", "n_pages", "n", "bad", rate.alias("rate"), (rate - F.lit(p.z) * sd).alias("lower"))


def judge_urls(pages: DataFrame, outcomes: DataFrame, rules: list[Rule],
               p: Reputation = Reputation()) -> DataFrame:
    """Per page: page_id, host, path, rule, verdict, and the host's rate and lower bound."""
    host, path = url_parts(F.col("url"))
    own = pages.select("page_id", host.alias("host"), path.alias("path"))
    rep = host_reputation(own.select("page_id", "host"), outcomes, p).checkpoint()
    total = rep.agg(F.coalesce(F.sum("n_pages"), F.lit(0)).alias("n")).first()["n"]
    joined = spread_join(own, rep.select("host", "rate", "lower", "n_pages"), "host", "n_pages", total)
    rule, verdict = longest_rule(F.col("host"), F.col("path"), rules)
    blocked = F.col("lower") > p.max_bad
    return joined.select("page_id", "host", "path", rule.alias("rule"),
                         F.coalesce(verdict, F.when(blocked, "block").otherwise("allow")).alias("verdict"),
                         "rate", "lower")
