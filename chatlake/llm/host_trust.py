"""URL filter: rules first, then trust and distrust spread over links between hosts.

Hosts are seeded with the share of their pages that rules allow and block. Trust flows along
links, as personalised PageRank; distrust flows against them, from a blocked host to those that
link to it. Both are one table of flows between hosts, aggregated before the first step, and each step is one
join and one sum over hosts, stored so that lineage stays short. A step passes on what the step
before added, until what is added to all hosts together is too little to matter.
"""

from __future__ import annotations

import string
from collections.abc import Sequence
from math import ceil, log
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatlake.llm.common import discard, stored

DAMPING, THRESHOLD = 0.85, 0.05
#: Sum of what a step may add to all hosts, in seeds, when spreading ends. A step adds at most `damping` times
#: what the step before added, so no host lacks more than damping / (1 - damping) times this.
TOLERANCE = 1e-6
LINK = r"""(?i)\bhref\s*=\s*["']?([^"'\s>]+)"""


class Rule(NamedTuple):
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


#: The rules of the registered query.
RULES = (
    Rule("org", "/", "allow"),
    Rule("example.org", "/es/", "block"),
    Rule("example.org", "/en/1", "block"),
    Rule("com", "/fr/", "allow"),
    Rule("com", "/de/", "block"),
)


def _after_scheme(url: Column) -> Column:
    """What follows the first ``://``; empty without one."""
    return F.when(F.instr(url, "://") > 0, F.regexp_replace(url, r"(?s)\A.*?://", "")).otherwise("")


def host_of(url: Column) -> Column:
    host = F.regexp_extract(_after_scheme(F.coalesce(url, F.lit(""))), r"\A[^/?#]*", 0)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    return F.regexp_extract(_after_scheme(F.coalesce(url, F.lit(""))), r"\A[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule that fits, as a struct (rule, verdict); null if none does."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        value = F.struct(F.lit(rule.name).alias("rule"), F.lit(rule.verdict).alias("verdict"))
        found = F.when(fits, value).otherwise(found)
    return found


def judged(pages: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """`page_id, host, path, rule, ruled` of every page."""
    split = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    fit = split.withColumn("fit", rule_of(F.col("host"), F.col("path"), rules))
    return fit.select("page_id", "host", "path", F.col("fit.rule").alias("rule"), F.col("fit.verdict").alias("ruled"))


def host_links(pages: DataFrame) -> DataFrame:
    """`(src, dst, n)`: links between different hosts, counted. Relative links stay on their host."""
    target = F.col("link")
    absolute = F.when(target.startswith("//"), F.concat(F.lit("x:"), target)).otherwise(target)
    return (
        pages.select(
            host_of(F.col("url")).alias("src"),
            F.explode(F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(LINK), F.lit(1))).alias("link"),
        )
        .filter(target.startswith("//") | target.rlike(r"\A[A-Za-z][A-Za-z0-9+.-]*://"))
        .select("src", host_of(absolute).alias("dst"))
        .filter("src <> dst and src <> '' and dst <> ''")
        .groupBy("src", "dst")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def spread(
    links: DataFrame,
    seeds: DataFrame,
    damping: float = DAMPING,
    steps: int | None = None,
    tolerance: float = TOLERANCE,
) -> DataFrame:
    """`(kind, host, score)` from `links(src, dst, n)` and `seeds(kind, host, seed)`.

    kind 'trust' moves from src to dst, in proportion to n over all that leaves src; kind
    'distrust' from dst to src, over all that arrives at dst. Without a number of steps, they go on
    until one adds at most `tolerance` seeds to all hosts together, however long the paths are.
    """
    ways = F.array(
        F.struct(F.lit("trust").alias("kind"), F.col("src").alias("host"), F.col("dst").alias("to")),
        F.struct(F.lit("distrust").alias("kind"), F.col("dst").alias("host"), F.col("src").alias("to")),
    )
    flows = stored(links.select("n", F.explode(ways).alias("w")).select("w.*", "n"))
    totals = stored(flows.groupBy("kind", "host").agg(F.sum("n").alias("total")))
    shares = stored(flows.join(totals, ["kind", "host"]).select("kind", "host", "to", (F.col("n") / F.col("total")).alias("share")))
    discard(flows, totals)
    scores = stored(seeds.select("kind", "host", ((1 - damping) * F.col("seed")).alias("score")).withColumn("added", F.col("score")))
    added, done, enough = _added(scores) if damping else 0.0, 0, tolerance * (1 - damping)
    # The steps of the slowest decay there can be, and a few for rounding.
    most = 3 + max(0, ceil(log(enough / added) / log(damping))) if added else 0
    while added and done != steps and (steps is not None or added > enough):
        if steps is None and done == most:
            raise RuntimeError(f"scores did not settle in {most} steps")
        moved = shares.join(scores.filter("added > 0"), ["kind", "host"]).select(
            "kind", F.col("to").alias("host"), (damping * F.col("share") * F.col("added")).alias("added")
        )
        both = moved.withColumn("score", F.col("added")).unionByName(scores.withColumn("added", F.lit(0.0)))
        following = stored(both.groupBy("kind", "host").agg(F.sum("score").alias("score"), F.sum("added").alias("added")))
        discard(scores)
        scores, done = following, done + 1
        added = _added(scores)
    return scores.select("kind", "host", "score")


def _added(scores: DataFrame) -> float:
    return scores.agg(F.sum("added")).first()[0] or 0.0


def filtered_urls(
    pages: DataFrame,
    rules: Sequence[Rule] = RULES,
    damping: float = DAMPING,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """`page_id, host, path, rule, verdict` of every row of `pages(page_id, url, html)`.

    The longest rule that fits decides. Where none fits, the page's host is blocked if its distrust is
    above both `threshold` and its trust, and allowed otherwise; so hosts that no seed reaches, and the empty
    host of urls that are null or have no ``://``, are allowed. Null html has no links. Repeated rows
    are judged alike; no rows give no rows; other columns are ignored.
    """
    pages = pages.select("page_id", F.col("url").cast("string"), F.col("html").cast("string"))
    known = stored(judged(pages, rules))
    counts = (
        known.filter("host <> ''")
        .groupBy("host")
        .agg(
            F.avg((F.coalesce("ruled", F.lit("")) == "allow").cast("int")).alias("trust"),
            F.avg((F.coalesce("ruled", F.lit("")) == "block").cast("int")).alias("distrust"),
        )
    )
    seeds = stored(
        counts.unpivot("host", ["trust", "distrust"], "kind", "seed").filter("seed > 0").select("kind", "host", "seed")
    )
    scores = spread(host_links(pages), seeds, damping)
    one = lambda kind: F.coalesce(F.max(F.when(F.col("kind") == kind, F.col("score"))), F.lit(0.0))
    # Scores hold 1 - damping of a seed; divided by it, a host on its own has its seed.
    hosts = stored(
        scores.groupBy("host")
        .agg((one("trust") / (1 - damping)).alias("trust"), (one("distrust") / (1 - damping)).alias("distrust"))
    )
    discard(seeds, scores)
    blocked = (F.col("distrust") > threshold) & (F.col("distrust") > F.col("trust"))
    by_host = F.when(F.coalesce(blocked, F.lit(False)), "block").otherwise("allow")
    return known.join(hosts, "host", "left").select(
        "page_id", "host", "path", "rule", F.coalesce("ruled", by_host).alias("verdict"), "trust", "distrust"
    )
