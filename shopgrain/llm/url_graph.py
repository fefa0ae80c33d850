"""URL verdicts from rules, and from trust that spreads over links between hosts.

Rules name a host, with all its subdomains, and a start of the path; the longest rule
that fits decides. A host is a trusted or blocked seed if rules decide most of its pages
that way. Over the edges between hosts, taken from absolute links of the pages, trust
spreads from the trusted seeds along links, and distrust from the blocked seeds against
them, both as personalised PageRank. A page without a rule is blocked if its host has
more distrust than trust and at least `threshold` times the average host's distrust.

Built-in expressions only. Links are summed per pair of hosts before anything else, so a
host with a third of all pages is one row; ranks join edges by host, with skewed hosts
left to adaptive splitting, and are written every few rounds, until they stand still.

Defined cases: a null url, or one without `://`, has empty host and path, fits no rule and
is allowed; null html has no links; links of a host to itself do not count; repeated rows
are pages of their own; without links or seeds only rules decide; an empty table gives no
rows; columns besides id, url and html are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import settled, whole

DAMPING = 0.85
#: Rounds whose plan is written as one.
ROUNDS_AT_ONCE = 4
#: Rounds go on until what is still on its way could change no host by this share of the
#: average host's rank. Each round leaves at most DAMPING of it, so they end.
PRECISION = 0.01
#: A share of ruled pages above this makes a host a seed.
SEED_SHARE = 0.5
THRESHOLD = 1.0

URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
LINK = r"(?i)<a\s[^>]*?href\s*=\s*[\"']?\s*(?:https?:)?//([^/?#\"'\s>]+)"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (
    Rule("com", "/", "allow"),
    Rule("example.com", "/en/", "block"),
    Rule("www.example.com", "/en/", "allow"),
    Rule("net", "/es/", "block"),
    Rule("net", "/fr/", "block"),
)


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(url, URL, 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(url, URL, 2)


def longest_rule(host: Column, path: Column, rules: tuple[Rule, ...]) -> Column:
    """Name and verdict of the longest rule that fits, else null."""
    found = F.lit(None).cast("struct<rule: string, verdict: string>")
    for rule in sorted(rules, key=lambda r: len(r.name)):  # the longest one comes to stand first
        inside = (host == rule.host) | host.endswith(f".{rule.host}")
        value = F.struct(F.lit(rule.name).alias("rule"), F.lit(rule.verdict).alias("verdict"))
        found = F.when(inside & path.startswith(rule.path), value).otherwise(found)
    return found


def host_edges(pages: DataFrame) -> DataFrame:
    """(source, target, links) between different hosts; pages: host, html."""
    target = F.explode(F.regexp_extract_all("html", F.lit(LINK), F.lit(1)))
    return (
        pages.where(F.col("host") != "")
        .select(F.col("host").alias("source"), target.alias("to"))
        .select("source", F.translate("to", UPPER, LOWER).alias("target"))
        .where("source != target")
        .groupBy("source", "target")
        .agg(F.count(F.lit(1)).alias("links"))
    )


def spread(edges: DataFrame, seeds: DataFrame, hosts: int) -> DataFrame:
    """(kind, host, rank): personalised PageRank of each kind, with ranks that sum to one.

    edges: kind, source, target, links. seeds: kind, host, weight. Mass at hosts without
    links is dropped, and ranks are scaled at the end: the same as sending it to the seeds.
    The number of hosts sets the precision, so trust goes as far as it can matter.
    """
    out = edges.groupBy("kind", "source").agg(F.sum("links").alias("all"))
    shares = settled(
        edges.join(out, ["kind", "source"]).select(
            "kind", F.col("source").alias("host"), "target", (F.col("links") / F.col("all")).alias("share")
        )
    )
    total = seeds.groupBy("kind").agg(F.sum("weight").alias("total"))
    start = settled(
        seeds.join(F.broadcast(total), "kind").select(
            "kind", "host", (F.col("weight") / F.col("total")).alias("rank")
        )
    )
    rank = start
    linked = not shares.isEmpty() and not start.isEmpty()
    while linked:
        for _ in range(ROUNDS_AT_ONCE):
            before = rank
            passed = rank.join(shares, ["kind", "host"]).select(
                "kind", F.col("target").alias("host"), (DAMPING * F.col("rank") * F.col("share")).alias("rank")
            )
            kept = start.select("kind", "host", ((1 - DAMPING) * F.col("rank")).alias("rank"))
            rank = kept.unionByName(passed).groupBy("kind", "host").agg(F.sum("rank").alias("rank"))
        both = before.select("kind", "host", "rank", F.lit(0.0).alias("now")).unionByName(
            rank.select("kind", "host", F.lit(0.0).alias("rank"), F.col("rank").alias("now"))
        )
        rank = settled(both.groupBy("kind", "host").agg(F.sum("rank").alias("old"), F.sum("now").alias("rank")))
        moved = rank.groupBy("kind").agg(F.sum(F.abs(F.col("rank") - F.col("old"))).alias("change"), F.sum("rank").alias("sum"))
        rank = rank.drop("old")
        on_its_way = F.col("change") * DAMPING / (1 - DAMPING) / F.col("sum")  # of ranks that sum to one
        linked = not moved.where(on_its_way * hosts >= PRECISION).isEmpty()
    sums = rank.groupBy("kind").agg(F.sum("rank").alias("sum"))
    return rank.join(F.broadcast(sums), "kind").select("kind", "host", (F.col("rank") / F.col("sum")).alias("rank"))


def host_verdicts(pages: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(host, trust, distrust, blocked) of all hosts; pages: host, verdict, html.

    Trust and distrust are in units of the average over hosts.
    """
    ruled = lambda verdict: F.count(F.when(F.col("verdict") == verdict, 1))
    hosts = settled(
        pages.where(F.col("host") != "")
        .groupBy("host")
        .agg(F.count(F.lit(1)).alias("n"), ruled("allow").alias("allowed"), ruled("block").alias("blocked"))
    )
    edges = settled(host_edges(pages))
    both = edges.select(F.lit("trust").alias("kind"), "source", "target", "links").unionByName(
        edges.select(F.lit("distrust").alias("kind"), F.col("target").alias("source"), F.col("source").alias("target"), "links")
    )
    seeds = hosts.select(
        F.explode(
            F.array(
                F.struct(F.lit("trust").alias("kind"), (F.col("allowed") / F.col("n")).alias("share")),
                F.struct(F.lit("distrust").alias("kind"), (F.col("blocked") / F.col("n")).alias("share")),
            )
        ).alias("s"),
        "host",
    ).where(F.col("s.share") > SEED_SHARE)
    known = settled(hosts.select("host").unionByName(edges.select(F.col("target").alias("host"))).distinct())
    number = known.count()
    ranks = spread(both, seeds.select("s.kind", "host", F.lit(1.0).alias("weight")), number)
    of = lambda kind: F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("rank"))), F.lit(0.0))
    per_host = ranks.groupBy("host").agg(of("trust").alias("trust"), of("distrust").alias("distrust"))
    scaled = per_host.select("host", *((F.col(c) * number).alias(c) for c in ("trust", "distrust")))
    blocked = (F.col("distrust") > F.col("trust")) & (F.col("distrust") >= threshold)
    return known.join(scaled, "host", "left").select(
        "host",
        F.coalesce("trust", F.lit(0.0)).alias("trust"),
        F.coalesce("distrust", F.lit(0.0)).alias("distrust"),
        F.coalesce(blocked, F.lit(False)).alias("blocked"),
    )


def judged(
    pages: DataFrame,
    rules: tuple[Rule, ...] = RULES,
    threshold: float = THRESHOLD,
    id_column: str = "page_id",
    url_column: str = "url",
    html_column: str = "html",
) -> DataFrame:
    """One row per page: id, host, path, rule, verdict, and the host's trust and distrust."""
    url = whole(F.col(f"`{url_column}`"))
    rows = pages.select(
        F.col(f"`{id_column}`").alias("id"),
        host_of(url).alias("host"),
        path_of(url).alias("path"),
        F.col(f"`{html_column}`").cast("string").alias("html"),
    )
    fit = longest_rule(F.col("host"), F.col("path"), rules)
    rows = rows.withColumn("fit", fit).select("id", "host", "path", "html", "fit.rule", "fit.verdict")
    hosts = settled(host_verdicts(rows.select("host", "verdict", "html"), threshold))
    by_host = F.when(F.coalesce("blocked", F.lit(False)), "block").otherwise("allow")
    return (
        rows.drop("html")
        .join(hosts, "host", "left")
        .select(
            F.col("id").alias(id_column),
            "host",
            "path",
            "rule",
            F.coalesce("verdict", by_host).alias("verdict"),
            F.coalesce("trust", F.lit(0.0)).alias("host_trust"),
            F.coalesce("distrust", F.lit(0.0)).alias("host_distrust"),
        )
    )
