"""Operator 9, URL filter by rules and by trust that spreads over the links between hosts.

A rule (host, path, verdict) fits a URL of its host or of a subdomain whose path starts with the
rule's; the longest rule wins. Other URLs get the verdict of their host. Trust starts at hosts
with URLs that a rule allows and follows links (personalised PageRank); distrust starts at hosts
with blocked URLs and goes against the links, to those who point there. A host is blocked if
distrust makes up at least ``threshold`` of distrust, trust and the host's share of all pages.

Links between hosts are the absolute links in the pages, and, both ways, a host and its nearest
parent domain that has pages too. All of it are joins and sums by host; a host with very many
pages or links is summed up in the map tasks first. Rounds go on until the scores have settled,
however long a chain of links is.

A null URL, or one without ``://``, has an empty host and path, no rule and the verdict allow.
Null html has no links. Repeated rows stay. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailmart import scratch

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DAMPING = 0.7
#: The rounds end when all scores together move by less than this part of one page's share.
TOLERANCE = 1e-4
#: Rounds between two tables, at the end of which the change is looked at.
STRIDE = 3
THRESHOLD = 0.5
#: Rules become one expression; a longer list belongs into a table.
MAX_RULES = 500
LINK = r"""(?i)href\s*=\s*["']?(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s<>]+)"""


class Rule(NamedTuple):
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def longest_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The winning rule as a struct of its text and verdict, or null."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules")
    found = F.lit(None).cast("struct<rule: string, verdict: string>")
    for rule in sorted(rules, key=lambda r: (len(r.text), len(r.host), r)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        named = F.struct(F.lit(rule.text).alias("rule"), F.lit(rule.verdict).alias("verdict"))
        found = F.when(fits, named).otherwise(found)
    return found


def _edges(pages: DataFrame, hosts: DataFrame) -> DataFrame:
    """(source, target, weight) between different hosts that have pages."""
    links = pages.where("host != ''").select(
        F.col("host").alias("source"),
        F.explode(F.array_distinct(F.regexp_extract_all("html", F.lit(LINK), 1))).alias("target"),
    )
    links = links.select("source", F.translate("target", UPPER, LOWER).alias("target"))
    links = links.where("source != target").groupBy("source", "target").agg(F.count("*").alias("w"))
    links = links.join(hosts.select(F.col("host").alias("target")), "target", "left_semi")
    labels = F.split("host", r"\.")
    parents = hosts.select(
        "host", F.posexplode(F.transform(F.sequence(F.lit(2), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))).alias("rank", "parent")
    ).where(F.size(labels) > 1)
    near = (
        parents.join(hosts.select(F.col("host").alias("parent")), "parent", "left_semi")
        .groupBy("host")
        .agg(F.min(F.struct("rank", "parent")).alias("near"))
        .select("host", F.col("near.parent").alias("parent"))
    )
    up = near.select(F.col("host").alias("source"), F.col("parent").alias("target"), F.lit(1).alias("w"))
    down = near.select(F.col("parent").alias("source"), F.col("host").alias("target"), F.lit(1).alias("w"))
    return (
        links.select("source", "target", "w").union(up).union(down)
        .groupBy("source", "target").agg(F.sum("w").alias("w"))
    )


def _steps(edges: DataFrame) -> DataFrame:
    """(from, to, trust, distrust): the share of each score that goes over a link in a round."""
    out = edges.groupBy("source").agg(F.sum("w").alias("total"))
    into = edges.groupBy("target").agg(F.sum("w").alias("total"))
    nothing = F.lit(0.0)
    share = F.col("w") / F.col("total")
    return (
        edges.join(out, "source")
        .select(F.col("source").alias("from"), F.col("target").alias("to"), share.alias("t"), nothing.alias("d"))
        .union(
            edges.join(into, "target").select(
                F.col("target").alias("from"), F.col("source").alias("to"), nothing, share
            )
        )
    )


def host_scores(
    pages: DataFrame, damping: float = DAMPING, tolerance: float = TOLERANCE
) -> DataFrame:
    """(host, trust, distrust, share) from pages (host, html, found).

    A round shrinks the sum of changes by the damping at least, so the scores differ from their
    limits by less than ``damping / (1 - damping)`` times the tolerance, and the number of rounds
    grows with the logarithm of the number of pages only.
    """
    counted = (
        pages.where("host != ''")
        .groupBy("host")
        .agg(
            F.count("*").alias("n"),
            F.count_if(F.col("found.verdict") == "allow").alias("good"),
            F.count_if(F.col("found.verdict") == "block").alias("bad"),
        )
    )
    counted = scratch.materialise(counted)
    totals = counted.agg(*(F.sum(c).alias(c) for c in ("n", "good", "bad"))).first()
    part = lambda c: F.col(c) / F.lit(float(totals[c] or 1) or 1.0)
    seeds = counted.select(
        "host", part("good").alias("trust0"), part("bad").alias("distrust0"), part("n").alias("share")
    )
    seeds = scratch.materialise(seeds)
    steps = scratch.materialise(_steps(scratch.materialise(_edges(pages, seeds.select("host")))))
    state = seeds.select("host", F.col("trust0").alias("trust"), F.col("distrust0").alias("distrust"))
    least = tolerance / max(totals["n"] or 1, 1)
    new = lambda seed, into: F.col(seed) * (1 - damping) + F.coalesce(into, F.lit(0.0)) * damping
    while True:
        for _ in range(STRIDE):
            moved = (
                steps.join(state.withColumnRenamed("host", "from"), "from")
                .groupBy(F.col("to").alias("host"))
                .agg(
                    F.sum(F.col("t") * F.col("trust")).alias("tin"),
                    F.sum(F.col("d") * F.col("distrust")).alias("din"),
                )
            )
            before = state.select("host", F.col("trust").alias("trust1"), F.col("distrust").alias("distrust1"))
            state = seeds.join(moved, "host", "left").select(
                "host", new("trust0", "tin").alias("trust"), new("distrust0", "din").alias("distrust")
            )
        change = F.abs(F.col("trust") - F.col("trust1")) + F.abs(F.col("distrust") - F.col("distrust1"))
        # A table is read again for the change, so the last round's step is the one looked at.
        state = scratch.materialise(state.join(before, "host").select("host", "trust", "distrust", change.alias("change")))
        if (state.agg(F.sum("change")).first()[0] or 0.0) < least:
            break
        state = state.drop("change")
    return state.join(seeds.select("host", "share"), "host")


def judge(
    pages: DataFrame,
    rules: Sequence[Rule],
    url_col: str = "url",
    html_col: str = "html",
    keep: Sequence[str] = ("page_id",),
    threshold: float = THRESHOLD,
) -> DataFrame:
    """The columns ``keep`` and (host, path, rule, verdict) of every URL."""
    url, html = F.col(url_col), F.col(html_col)
    rows = pages.select(
        F.struct(*keep).alias("kept"), host_of(url).alias("host"), path_of(url).alias("path"), html.alias("html")
    )
    rows = rows.withColumn("found", longest_rule(F.col("host"), F.col("path"), rules))
    scores = host_scores(rows)
    # Rounded, so that the order of sums does not decide.
    bad = F.round("distrust", 12)
    rest = F.round("trust", 12) + F.round("share", 12)
    blocked = scores.where(bad > 0).where(bad >= F.lit(threshold) * (bad + rest)).select("host", F.lit(True).alias("blocked"))
    return rows.drop("html").join(blocked, "host", "left").select(
        "kept.*",
        "host",
        "path",
        F.col("found.rule").alias("rule"),
        F.coalesce("found.verdict", F.when(F.col("blocked"), "block").otherwise("allow")).alias("verdict"),
    )
