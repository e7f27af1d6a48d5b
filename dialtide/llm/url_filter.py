"""URL filter: rules on hosts and paths, and trust that spreads over links.

A rule that fits a URL decides it. Other URLs take the verdict of their host.
Trust spreads from hosts whose pages the rules allow along links (personalised
PageRank). Distrust spreads against the links from hosts whose pages they block: a
host is distrusted as far as its own links lead to distrusted hosts that are not
trusted as much. That is a share of its own links, so it does not matter how many
others link to the same hosts. Both are whole numbers, so the result does not
depend on the order of addition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import ascii_lower

#: (host and path, verdict)
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
UNIT = 1_000_000_000  #: a host whose pages are all decided one way is a seed of this size
RESTART_PERCENT = 15
#: Rounds of spreading, if scores still change: each round takes 15 % off what is left to
#: come, so after these it is under a ten-thousandth of a unit.
ROUNDS = 57
#: A host is blocked if its distrust reaches this and exceeds its trust: about half of its links lead to blocked hosts.
THRESHOLD = UNIT * 4 // 10
#: Absolute links of a page; the first group is the host.
LINK = r"""(?i)\shref\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s<>]+)"""


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/ ? #``, A-Z lower-cased; path: from there up to ``? #``."""
    there = F.instr(url, "://")
    rest = F.when(there > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise(F.lit(""))
    return (
        ascii_lower(F.regexp_extract(rest, r"^[^/?#]*", 0)),
        F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1),
    )


def _fitting_rule(rules: Sequence[tuple[str, str]]) -> Column:
    """The longest rule that fits (host, path), as a struct; null if none does.

    The rules are a literal table by host, so every page is decided in its row.
    """
    by_host: dict[str, list[tuple[str, str, str]]] = {}
    for text, verdict in rules:
        host, slash, path = text.partition("/")
        by_host.setdefault(host.lower(), []).append((text, slash + path, verdict))
    entries = [
        x
        for host, own in by_host.items()
        for x in (
            F.lit(host),
            F.array(
                *[
                    F.struct(
                        F.lit(len(text)).alias("size"),
                        F.lit(text).alias("rule"),
                        F.lit(path).alias("path"),
                        F.lit(verdict).alias("verdict"),
                    )
                    for text, path, verdict in own
                ]
            ),
        )
    ]
    if not entries:
        return F.lit(None).cast("struct<size:int,rule:string,path:string,verdict:string>")
    table = F.create_map(*entries)
    labels = F.split("host", r"\.", -1)
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), ".")
    )
    fitting = F.filter(
        F.flatten(F.filter(F.transform(suffixes, lambda s: F.try_element_at(table, s)), lambda x: x.isNotNull())),
        lambda r: F.col("path").startswith(r["path"]),
    )
    return F.when(F.col("host") != "", F.array_max(fitting))


def ruled_pages(pages: DataFrame, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """page_id, host, path and the fitting rule with its verdict."""
    host, path = host_and_path(F.col("url"))
    df = pages.select(F.col("page_id"), F.col("url").cast("string").alias("url")).select(
        "page_id", F.coalesce(host, F.lit("")).alias("host"), F.coalesce(path, F.lit("")).alias("path")
    )
    return df.withColumn("fit", _fitting_rule(rules)).select(
        "page_id", "host", "path", F.col("fit.rule").alias("rule"), F.col("fit.verdict").alias("ruled")
    )


def host_links(pages: DataFrame) -> DataFrame:
    """Distinct (source, target) pairs of different hosts, from the links in the pages."""
    host, _ = host_and_path(F.col("url"))
    links = pages.select(
        F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html")
    ).select(
        host.alias("source"),
        F.explode(F.array_distinct(F.regexp_extract_all("html", F.lit(LINK), F.lit(1)))).alias("target"),
    )
    links = links.select("source", ascii_lower(F.col("target")).alias("target"))
    return links.filter("source <> '' AND source <> target").distinct()


def _spread(start: DataFrame, step, rounds: int, name: str) -> DataFrame:
    """(host, score) after ``step`` has been taken until no score changes, ``rounds`` times at most."""
    scores = start
    for _ in range(rounds):
        new = materialize(step(scores).join(scores.withColumnRenamed("score", "old"), "host"), name)
        scores, moved = new.select("host", "score"), not new.filter("score <> old").isEmpty()
        if not moved:
            break
    return scores


def host_scores(pages: DataFrame, ruled: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """host, trust and distrust, 0 to :data:`UNIT`, after spreading over the host graph."""
    links = materialize(host_links(pages), "host-links")
    out = links.groupBy("source").agg(F.count("*").alias("degree"))
    edges = materialize(links.join(out, "source").select(F.col("source").alias("u"), F.col("target").alias("v"), "degree"), "host-edges")
    seeds = (
        ruled.filter("host <> ''")
        .groupBy("host")
        .agg(
            F.count("*").alias("n"),
            F.count_if(F.col("ruled") == "allow").alias("allowed"),
            F.count_if(F.col("ruled") == "block").alias("blocked"),
        )
        .select("host", F.expr(f"allowed * {UNIT} div n").alias("allow"), F.expr(f"blocked * {UNIT} div n").alias("block"))
    )
    none = F.lit(0).cast("long")
    nodes = seeds.union(edges.select(F.col("v").alias("host"), none, none))
    nodes = materialize(nodes.groupBy("host").agg(F.max("allow").alias("allow"), F.max("block").alias("block")), "host-seeds")
    if edges.isEmpty():
        return nodes.select("host", F.col("allow").alias("trust"), F.col("block").alias("distrust"))
    restart = f"allow * {RESTART_PERCENT} div 100"

    def trusting(scores: DataFrame) -> DataFrame:
        sent = edges.join(scores.withColumnRenamed("host", "u"), "u").groupBy(F.col("v").alias("host"))
        sent = sent.agg(F.sum(F.expr("score div degree")).alias("received"))
        new = F.expr(f"{restart} + coalesce(received, 0L) div 100 * {100 - RESTART_PERCENT}")
        return nodes.join(sent, "host", "left").select("host", new.alias("score"))

    trust = _spread(nodes.select("host", F.expr(restart).alias("score")), trusting, rounds, "host-trust")
    trust = trust.select("host", F.expr(f"least({UNIT}L, score * 100 div {RESTART_PERCENT})").alias("trust"))
    known = materialize(nodes.join(trust, "host"), "host-trust")

    def distrusting(scores: DataFrame) -> DataFrame:
        bad = scores.join(known.select("host", "trust"), "host").select(F.col("host").alias("v"), F.expr("greatest(score - trust, 0L)").alias("bad"))
        share = edges.join(bad, "v").groupBy(F.col("u").alias("host")).agg(F.expr("sum(bad) div max(degree)").alias("share"))
        new = F.expr(f"block + ({UNIT} - block) * coalesce(share, 0L) div {UNIT} * {100 - RESTART_PERCENT} div 100")
        return known.join(share, "host", "left").select("host", new.alias("score"))

    distrust = _spread(known.select("host", F.col("block").alias("score")), distrusting, rounds, "host-distrust")
    return known.select("host", "trust").join(distrust.withColumnRenamed("score", "distrust"), "host")


def url_filter(
    pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, rounds: int = ROUNDS, threshold: int = THRESHOLD
) -> DataFrame:
    """Each page with the rule that fits it, if any, and its verdict.

    A rule fits its host and all subdomains if the path starts with the rule's;
    the longest text wins. Pages without a fitting rule are blocked if the
    distrust of their host reaches ``threshold`` and exceeds its trust, so a
    host that links to a blocked one stays allowed where a trusted host vouches
    for it. A null url, one without ``://`` and one with an empty host fit no
    rule and are allowed; a null html has no links, long ones are read whole.
    Repeated pages are judged alike, an empty table gives an empty result, and
    other columns are not read, whatever their names.

    Returns page_id, host, path, rule, verdict.
    """
    ruled = materialize(ruled_pages(pages, rules), "ruled-pages")
    bad = host_scores(pages, ruled, rounds).filter((F.col("distrust") >= threshold) & (F.col("distrust") > F.col("trust")))
    bad = materialize(bad.select("host", F.lit("block").alias("spread")), "blocked-hosts")
    return ruled.join(bad, "host", "left").select(
        "page_id", "host", "path", "rule", F.coalesce("ruled", "spread", F.lit("allow")).alias("verdict")
    )
