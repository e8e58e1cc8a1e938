"""Host reputation by empirical Bayes, with listed rules before it.

Labelled page outcomes are counted per host, registered domain and suffix. Each level's rate has a beta prior whose mean
is the posterior mean of the level above and whose weight is fitted to the spread of that level's rates; a host is
blocked if even the lower bound of its posterior says that too many of its pages are bad.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoploom.llm.common import ascii_lower, nested, unnested

RESULTS = ("host", "path", "rule", "verdict", "bad_rate", "bad_bound")
#: A host is blocked if its bad rate is above MOST_BAD with this many standard deviations to spare.
MOST_BAD, DEVIATIONS = 0.5, 1.645
LEAST_WEIGHT, MOST_WEIGHT = 2.0, 1000.0
# Suffixes under which names are registered one level deeper.
DEEP_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "net.au", "org.au", "co.nz", "co.jp", "com.br", "com.cn", "co.in", "co.za", "com.mx")


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path

    def fits(self) -> Column:
        host = F.col("host")
        return ((host == self.host) | host.endswith("." + self.host)) & F.col("path").startswith(self.path)


# The listed rules.
RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)


def host_of(url: Column) -> Column:
    """What stands after the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; empty without `://`."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """What follows the host up to `?`, `#` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def suffix_of(host: Column) -> Column:
    """The part of a host under which names are registered; the whole host if it has no dot."""
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(*DEEP_SUFFIXES), two).otherwise(F.substring_index(host, ".", -1))


def domain_of(host: Column) -> Column:
    """The registered domain: the suffix and the name before it."""
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(*DEEP_SUFFIXES), F.substring_index(host, ".", -3)).otherwise(two)


def _weighted(level: DataFrame) -> DataFrame:
    """Weight of the prior in pages, by moments: how far the rates of a level spread beyond what chance explains.

    `level` holds n, bad and the prior's mean for each of its units. One row of sums is all this needs.
    """
    expected = F.col("prior") * (1 - F.col("prior"))
    found = level.agg(
        F.sum(F.pow(F.col("bad") - F.col("n") * F.col("prior"), 2) - F.col("n") * expected).alias("over"),
        F.sum(F.col("n") * (F.col("n") - 1) * expected).alias("most"),
    )
    share = F.col("over") / F.col("most")  # 1 / (weight + 1), if rates follow the beta distribution
    weight = F.when(F.col("most") > 0, F.when(share > 0, 1 / share - 1).otherwise(MOST_WEIGHT)).otherwise(LEAST_WEIGHT)
    return found.select(F.greatest(F.lit(LEAST_WEIGHT), F.least(F.lit(MOST_WEIGHT), weight)).alias("weight"))


def _posterior(level: DataFrame, unit: str, keep: list[str]) -> DataFrame:
    """The level's units with their posterior mean as `<unit>_rate` and the prior's weight."""
    rated = level.crossJoin(F.broadcast(_weighted(level)))  # the right side has one row
    rate = (F.col("bad") + F.col("weight") * F.col("prior")) / (F.col("n") + F.col("weight"))
    return rated.select(*keep, rate.alias(f"{unit}_rate"), (F.col("n") + F.col("weight")).alias(f"{unit}_weight"))


def reputations(outcomes: DataFrame, deviations: float = DEVIATIONS) -> DataFrame:
    """host, host_rate, bound, domain, suffix for each host in `outcomes` (host, bad: 0, 1 or null).

    Null outcomes count for nothing; a host without outcomes gets its domain's rate.
    """
    hosts = outcomes.groupBy("host").agg(F.count("bad").alias("n"), F.sum(F.coalesce(F.col("bad"), F.lit(0))).alias("bad"))
    hosts = hosts.withColumns({"domain": domain_of(F.col("host")), "suffix": suffix_of(F.col("host"))})
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    overall = suffixes.agg(((F.sum("bad") + 1) / (F.sum("n") + 2)).alias("prior"))

    suffixes = _posterior(suffixes.crossJoin(F.broadcast(overall)), "suffix", ["suffix"])
    domains = _posterior(domains.join(suffixes, "suffix").withColumn("prior", F.col("suffix_rate")), "domain", ["domain", "suffix"])
    hosts = _posterior(hosts.join(domains, ["domain", "suffix"]).withColumn("prior", F.col("domain_rate")), "host", ["host", "domain", "suffix"])
    deviation = F.sqrt(F.col("host_rate") * (1 - F.col("host_rate")) / (F.col("host_weight") + 1))
    return hosts.select("host", "domain", "suffix", "host_rate", (F.col("host_rate") - deviations * deviation).alias("bound"))


def judged(
    pages: DataFrame, outcomes: DataFrame, url: str = "url", rules: tuple[Rule, ...] = RULES, most_bad: float = MOST_BAD, deviations: float = DEVIATIONS
) -> DataFrame:
    """`pages` with host, path, rule, verdict, bad_rate and bad_bound (rounded to six places).

    The longest rule that fits decides (of equally long ones the first listed); without one, the posterior of the host
    does. A null url has an empty host, which is rated like any other. A host that `outcomes` (host, bad) doesn't name
    is allowed, with null figures. Repeated pages are judged alike, columns named like a result are replaced.
    """
    found = nested(pages, host=host_of(F.col(f"`{url}`")), path=path_of(F.col(f"`{url}`")))
    by_length = sorted(rules, key=lambda r: -len(r.text))
    rule = F.coalesce(*[F.when(r.fits(), F.lit(r.text)) for r in by_length], F.lit(None).cast("string"))
    listed = reduce(lambda other, r: F.when(F.col("rule") == r.text, F.lit(r.verdict)).otherwise(other), by_length, F.lit(None).cast("string"))
    rates = reputations(outcomes, deviations).select("host", "host_rate", "bound")
    method = F.when(F.col("bound") > most_bad, F.lit("block")).otherwise(F.lit("allow"))
    return unnested(
        found.withColumn("rule", rule).join(rates, "host", "left").select(
            "row", "host", "path", "rule", F.coalesce(listed, method).alias("verdict"),
            F.round("host_rate", 6).alias("bad_rate"), F.round("bound", 6).alias("bad_bound"),
        ),
        *RESULTS,
    )


def document_outcomes(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """host, bad for each page: a page is bad if the document whose number ends its path is of low quality or toxic.

    Several labels of one document count as bad if any does. Pages without a labelled document have a null outcome.
    """
    number = F.regexp_extract(path_of(F.col("url")), r"([0-9]{1,18})(?:\.html|/)?$", 1)
    thin = pages.select(host_of(F.col("url")).alias("host"), number.try_cast("bigint").alias("doc_id"))
    bad = labels.where("doc_id is not null").groupBy("doc_id").agg(F.max(((F.col("quality") == 0) | (F.col("toxic") == 1)).cast("int")).alias("bad"))
    return thin.join(bad, "doc_id", "left").select("host", "bad")
