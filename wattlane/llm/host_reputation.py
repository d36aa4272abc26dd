"""URL filters: fixed rules first, then the reputation of the host.

A url's host is what stands between its first ``://`` and the next ``/``, ``?``, ``#`` or the end,
with A-Z lower-cased; its path goes on from there to ``?``, ``#`` or the end. A ``Rule`` fits its
own host and all hosts below it, where the path starts with the rule's; the longest one wins.

Pages that no rule decides are judged by labelled outcomes of pages. Bad outcomes of a host are
binomial, their rate has a beta prior around the rate of its registered domain, whose own
rate has one around its suffix's, and that one around the rate of all. How strongly each
level holds its children together (the weight of the prior, in pages) is estimated from the
outcomes by their second moments. What a child adds to its parent is left out of its own
prior, so no outcome counts twice. A host is blocked when the lower posterior bound of its
bad rate exceeds ``most_bad``: few outcomes block nobody, unless the domain speaks for them.

Defined cases: a null url or one without ``://`` has an empty host and path and shares the
reputation of all such pages; a null id has no outcome; an id with several outcomes is bad
if any of them is; null outcomes are none; repeated pages are pages of their own, each with its
outcome; without outcomes nothing but rules blocks; an empty table gives an empty table;
other columns are not read. User names and ports belong to the host, as far as rules
are concerned, but not to the name its reputation goes by.

Scale: outcomes meet pages by id, hosts are counted by an aggregate that combines before
its shuffle, and what is left is one row a host. Pages meet only the blocked hosts, one
row each, in a join whose large side Spark can split.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattlane.llm.common import kept_aside

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Suffixes of more than one label under which anyone registers names; others have one label.
SUFFIXES = ("co.uk", "org.uk", "ac.uk", "com.au", "co.jp", "com.br", "co.in", "co.nz", "com.cn")

#: Weight of the prior of all pages, and bounds of the correlation inside a group.
START = 0.5
LEAST_CORRELATION, MOST_CORRELATION = 0.001, 0.9
#: Correlation where no group has two outcomes.
USUAL_CORRELATION = 0.05

MOST_BAD = 0.5
DEVIATIONS = 1.645

LEVELS = ("suffix", "domain", "host")


@dataclass(frozen=True)
class Rule:
    """``verdict`` is allow or block; ``path`` starts with a slash."""

    verdict: str
    host: str
    path: str = "/"

    @property
    def text(self) -> str:
        return self.host + self.path

    def fits(self, host: Column, path: Column) -> Column:
        below = (host == self.host) | host.endswith(f".{self.host}")
        return below & path.startswith(self.path)


def host_of(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _longest_first(rules: Sequence[Rule]) -> list[Rule]:
    """Of rules equally long, the one of the longer host goes first."""
    return sorted(rules, key=lambda r: (-len(r.text), -len(r.host), r.text))


def rule_column(rules: Sequence[Rule], value: str, host: Column, path: Column) -> Column:
    """``text`` or ``verdict`` of the longest rule that fits, else null. The rules are a
    parameter, so they are part of the plan, not a table."""
    found = F.lit(None).cast("string")
    for rule in reversed(_longest_first(rules)):
        found = F.when(rule.fits(host, path), F.lit(getattr(rule, value))).otherwise(found)
    return found


def named_levels(host: Column, suffixes: Sequence[str]) -> dict[str, Column]:
    """Suffix, registered domain and host by which a reputation goes."""
    bare = F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r":[0-9]*\z", "")
    labels = F.split(bare, r"\.", -1)

    def last(n: int) -> Column:
        # slice() refuses to start before the first label.
        start = F.greatest(F.size(labels) - n + 1, F.lit(1))
        return F.array_join(F.slice(labels, start, F.lit(n)), ".")

    depth = F.lit(1)
    for n in sorted({s.count(".") + 1 for s in suffixes}):
        known = [s for s in suffixes if s.count(".") + 1 == n]
        depth = F.when(last(n).isin(*known), F.lit(n)).otherwise(depth)
    suffix, domain = last(1), last(2)
    for n in sorted({s.count(".") + 1 for s in suffixes}):
        suffix = F.when(depth == n, last(n)).otherwise(suffix)
        domain = F.when(depth == n, last(n + 1)).otherwise(domain)
    return {"suffix": suffix, "domain": domain, "host": bare}


def host_counts(pages: DataFrame, outcomes: DataFrame) -> DataFrame:
    """``suffix``, ``domain``, ``host``, labelled pages ``n`` and bad ones ``y`` of every host."""
    known = (
        outcomes.where(F.col("bad").isNotNull())
        .groupBy(F.col("page_id").alias("known_id"))
        .agg(F.max(F.col("bad").cast("int")).alias("bad"))
    )
    return (
        pages.join(known, pages["page_id"] == known["known_id"], "left")
        .groupBy(*LEVELS)
        .agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("y"))
    )


def _weight(groups: DataFrame) -> float:
    """Weight of the prior whose mean is ``mean``, from groups with ``n`` and ``y``.

    A beta-binomial count has the variance n m (1 - m) (1 + (n - 1) r), where r is the
    correlation of two outcomes of one group; r is set so that squared deviations sum
    up to what is expected of them, and the weight is (1 - r) / r.
    """
    n, y, mean = F.col("n"), F.col("y"), F.col("mean")
    one = n * mean * (1 - mean)
    sums = groups.agg(
        F.sum((y - n * mean) ** 2).alias("squares"),
        F.sum(one).alias("plain"),
        F.sum(one * (n - 1)).alias("pairs"),
    ).first()
    r = (sums["squares"] - sums["plain"]) / sums["pairs"] if sums["pairs"] else USUAL_CORRELATION
    r = min(max(r, LEAST_CORRELATION), MOST_CORRELATION)
    return (1 - r) / r


def reputations(counts: DataFrame) -> DataFrame:
    """``host`` with the beta posterior ``a``, ``b`` of its bad rate.

    ``counts`` is read once a level; hand over a table that was kept.
    """
    total = counts.agg(F.sum("n").alias("n"), F.sum("y").alias("y")).first()
    n, y = total["n"] or 0, total["y"] or 0
    # The prior of a level's groups: the mean of the parent without the group itself.
    groups = counts.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("y").alias("y"))
    mean = (START + y - F.col("y")) / (2 * START + n - F.col("n"))
    groups = groups.withColumn("mean", mean)
    weight = _weight(groups)
    for parent, level in zip(LEVELS, LEVELS[1:], strict=False):
        above = groups.select(
            parent,
            F.col("n").alias("above_n"),
            F.col("y").alias("above_y"),
            (F.lit(weight) * F.col("mean")).alias("prior_y"),
        )
        keys = LEVELS[: LEVELS.index(level) + 1]
        below = counts.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("y").alias("y"))
        mean = (F.col("prior_y") + F.col("above_y") - F.col("y")) / (
            F.lit(weight) + F.col("above_n") - F.col("n")
        )
        groups = below.join(above, parent).select(*keys, "n", "y", mean.alias("mean"))
        weight = _weight(groups)
    return groups.select(
        "host",
        "n",
        "y",
        (F.lit(weight) * F.col("mean") + F.col("y")).alias("a"),
        (F.lit(weight) * (1 - F.col("mean")) + F.col("n") - F.col("y")).alias("b"),
    )


def lower_bound(deviations: float) -> Column:
    """So many standard deviations under the posterior mean."""
    a, b = F.col("a"), F.col("b")
    return a / (a + b) - F.lit(deviations) * F.sqrt(a * b / (a + b + 1)) / (a + b)


def filter_urls(
    pages: DataFrame,
    outcomes: DataFrame,
    rules: Sequence[Rule],
    *,
    suffixes: Sequence[str] = SUFFIXES,
    most_bad: float = MOST_BAD,
    deviations: float = DEVIATIONS,
) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule`` (null: none fits) and ``verdict`` of each page of
    ``pages`` (``page_id``, ``url``), by ``outcomes`` (``page_id``, ``bad``)."""
    parts = pages.select("page_id", host_of(F.col("url")).alias("given"), path_of(F.col("url")).alias("path"))
    named = parts.select("*", *(c.alias(k) for k, c in named_levels(F.col("given"), suffixes).items()))
    counts = kept_aside(host_counts(named.select("page_id", *LEVELS), outcomes))
    blocked = (
        reputations(counts)
        .where(lower_bound(deviations) > most_bad)
        .select(F.col("host").alias("bad_host"))
    )
    given, path = F.col("given"), F.col("path")
    by_method = F.when(F.col("bad_host").isNull(), "allow").otherwise("block")
    return named.join(blocked, named["host"] == blocked["bad_host"], "left").select(
        "page_id",
        given.alias("host"),
        "path",
        rule_column(rules, "text", given, path).alias("rule"),
        F.coalesce(rule_column(rules, "verdict", given, path), by_method).alias("verdict"),
    )
