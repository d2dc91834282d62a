"""URL filters: rules first, then trust and distrust along the host graph.

A rule names a host and the beginning of a path; it fits that host and its subdomains, and the
longest fitting rule decides. Hosts pass on what the rules say of their pages: a personalised
PageRank carries trust from hosts with allowed pages along links, and one over reversed links
carries distrust from hosts with blocked pages to those that link to them. A host restarts at the
share of its pages that rules allow (for distrust: block), so both ranks read as shares. A third
number, ``led``, is the chance that links lead from a host to a blocked page: a link to another
host is followed with ``DAMPING``, from page shares that are not blocked it goes on. Unlike
distrust, which a blocked host divides among all that link to it, it does not fall with their
number. Pages without a rule are blocked if their host's distrust reaches ``THRESHOLD`` and exceeds
its trust, or if ``led`` reaches ``LED`` and exceeds its trust.

Host edges are counted from the hyperlinks of all pages; a link without a host stays on its own.
Edges are aggregated before they meet, every round is a join and an aggregation over hosts, and
rounds are staged, so a hub host is one row a neighbour.

A null url, or one without ``://``, has an empty host and path, fits no rule, and its host is
judged as any other is (it takes no part in links). Null html has no links. Repeated rows count
again as pages and get equal verdicts; extra columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from replicheck.sources import Workspace

ROUNDS, DAMPING, THRESHOLD, LED = 12, 0.85, 0.5, 0.5
#: Rounds between two staged tables.
STAGED = 4
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_rule(rule: str) -> tuple[str, str]:
    host, _, path = rule.partition("/")
    return host, "/" + path


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.substring(url, at + 3, F.length(url))
    host = F.translate(F.regexp_extract(rest, r"\A([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(rest, r"\A[^/?#]*([^?#]*)", 1)
    has = F.coalesce(at > 0, F.lit(False))
    return F.when(has, host).otherwise(""), F.when(has, path).otherwise("")


def rule_for(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest fitting rule of ``(verdict, rule)``, and its verdict; null where none fits."""
    name = said = None
    for verdict, rule in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
        own, begin = split_rule(rule)
        fits = ((host == own) | host.endswith("." + own)) & path.startswith(begin)
        name = F.when(fits, rule) if name is None else name.when(fits, rule)
        said = F.when(fits, verdict) if said is None else said.when(fits, verdict)
    null = F.lit(None).cast("string")
    return (null, null) if name is None else (name, said)


def host_edges(pages: DataFrame) -> DataFrame:
    """``(src, dst, links)`` from the hyperlinks of ``(host, html)``."""
    target = F.explode(F.regexp_extract_all("html", F.lit(r"(?i)<a\s[^>]*?href\s*=\s*[\"']?([^\"'\s>]*)"), F.lit(1)))
    links = pages.filter("host <> ''").select(F.col("host").alias("src"), target.alias("url"))
    # a link to //host lacks the scheme only
    full = F.when(F.col("url").startswith("//"), F.concat(F.lit("http:"), "url")).otherwise(F.col("url"))
    absolute = full.rlike(r"\A[A-Za-z][A-Za-z0-9+.-]*://")
    dst = F.when(absolute, host_and_path(full)[0]).otherwise(F.col("src"))
    return links.select("src", dst.alias("dst")).filter("dst <> ''").groupBy("src", "dst").agg(F.count("*").alias("links"))


def spread(seeds: DataFrame, edges: DataFrame, ws: Workspace, rounds: int = ROUNDS, damping: float = DAMPING) -> DataFrame:
    """``(host, trust, distrust, led)`` from ``seeds`` ``(host, trust, distrust)`` after ``rounds``."""
    leaves = edges.groupBy("src").agg(F.sum("links").alias("total"), F.sum(F.when(F.col("src") != F.col("dst"), F.col("links"))).alias("outside"))
    enters = edges.groupBy("dst").agg(F.sum("links").alias("entering"))
    zero = F.lit(0.0)
    outward = F.when(F.col("src") != F.col("dst"), F.col("links") / F.col("outside")).otherwise(zero)
    ways = ws.stage(
        edges.join(leaves, "src")
        .select(F.col("src").alias("at"), F.col("dst").alias("to"), (F.col("links") / F.col("total")).alias("t"), zero.alias("d"), zero.alias("l"))
        .union(
            edges.join(enters, "dst").join(leaves, "src")
            .select(F.col("dst").alias("at"), F.col("src").alias("to"), zero.alias("t"), (F.col("links") / F.col("entering")).alias("d"), outward.alias("l"))
        )
        .groupBy("at", "to")
        .agg(F.sum("t").alias("t"), F.sum("d").alias("d"), F.sum("l").alias("l")),
        "ways",
    )
    again = seeds.select("host", (F.col("trust") * (1 - damping)).alias("trust"), (F.col("distrust") * (1 - damping)).alias("distrust"), zero.alias("led"), F.col("distrust").alias("seed"))
    now = seeds.select("host", "trust", "distrust", zero.alias("led"), F.col("distrust").alias("seed"))
    for k in range(1, rounds + 1):
        reached = F.col("seed") + (1 - F.col("seed")) * F.col("led")  # a blocked page, at once or by links
        passed = (
            now.join(ways, now["host"] == ways["at"])
            .select(F.col("to").alias("host"), (F.col("trust") * F.col("t") * damping).alias("trust"), (F.col("distrust") * F.col("d") * damping).alias("distrust"),
                    (reached * F.col("l") * damping).alias("led"), zero.alias("seed"))
        )
        now = passed.union(again).groupBy("host").agg(*[F.sum(c).alias(c) for c in ("trust", "distrust", "led", "seed")])
        if k % STAGED == 0:
            now = ws.stage(now, "ranks")
    return now.drop("seed")


def judge(pages: DataFrame, rules: Sequence[tuple[str, str]], ws: Workspace | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """``page_id, host, path, rule, verdict, trust, distrust`` of every page."""
    ws = ws or Workspace(pages.sparkSession)
    host, path = host_and_path(F.col("url"))
    split = pages.select("page_id", "html", host.alias("host"), path.alias("path"))
    edges = ws.stage(host_edges(split), "edges")
    rule, said = rule_for(F.col("host"), F.col("path"), rules)
    ruled = split.select("page_id", "host", "path", rule.alias("rule"), said.alias("said"))
    share = lambda v: F.avg(F.coalesce((F.col("said") == v).cast("double"), F.lit(0.0)))
    seeds = ws.stage(
        ruled.groupBy("host").agg(share("allow").alias("trust"), share("block").alias("distrust")), "seeds"
    )
    ranks = spread(seeds, edges, ws)
    bad = (F.col("distrust") >= threshold) & (F.col("distrust") > F.col("trust"))
    bad = bad | (F.col("led") >= LED) & (F.col("led") > F.col("trust"))
    return ruled.join(ranks, "host", "left").select(
        "page_id", "host", "path", "rule",
        F.coalesce("said", F.when(bad, "block").otherwise("allow")).alias("verdict"),
        "trust", "distrust",
    )
