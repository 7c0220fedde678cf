"""URL filter: rules for hosts and paths, and trust that spreads over links between hosts.

Where no rule speaks, a host is judged by its neighbours: personalised
PageRank carries trust from hosts with allowed pages along links, and distrust
from hosts that a rule blocks as a whole backwards along links, to those that
link to them.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagedframes.llm.common import ascii_lower, cut

#: a link to another host: an href with a scheme or two slashes
_LINK = r"""(?i)href\s*=\s*["']?(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s>]+)"""


@dataclass(frozen=True)
class Rule:
    """``verdict`` ("allow" or "block") for ``pattern``: a host, then a path from its first slash on."""

    verdict: str
    pattern: str


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://`` or for null."""
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """From the host's end up to ``?``, ``#`` or the end; empty without ``://`` or for null."""
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def host_links(pages: DataFrame) -> DataFrame:
    """``src, dst, n``: how many times pages of one host link to another host. Null html has no links."""
    targets = F.transform(F.regexp_extract_all("html", F.lit(_LINK), 1), ascii_lower)
    links = pages.select(host_of(F.col("url")).alias("src"), F.explode(targets).alias("dst"))
    return links.filter("src <> dst and src <> '' and dst <> ''").groupBy("src", "dst").agg(F.count("*").alias("n"))


def propagate(
    edges: DataFrame, seeds: DataFrame, damping: float = 0.85, tolerance: float = 1e-6
) -> DataFrame:
    """``host, score``: personalised PageRank over ``edges`` (``src, dst, n``) from ``seeds`` (``host``), which share 1.

    Rounds end when no host is new and no score moves by more than ``tolerance`` of itself, however many links away
    from a seed that is: what a round hands on is ``damping`` of the one before, so it comes to nothing. Scores shrink
    as seeds and links grow in number, so nothing here looks at their size. What a host without links holds is not
    handed on; giving it back to the seeds would multiply all scores by one number. No seeds, no rows.
    """
    n_seeds = seeds.count()
    start = cut(seeds.select("host", F.lit(1.0 / max(n_seeds, 1)).alias("score")), "seeds")
    scores = start.select("host", (F.col("score") * (1 - damping)).alias("score")).withColumn("moved", F.col("score"))
    out = edges.groupBy("src").agg(F.sum("n").alias("total"))
    steps = cut(edges.join(out, "src").select("src", "dst", (damping * F.col("n") / F.col("total")).alias("share")), "steps")
    while n_seeds:
        flow = scores.filter("moved > 0").join(steps, scores["host"] == steps["src"])
        flow = flow.select(F.col("dst").alias("host"), (F.col("moved") * F.col("share")).alias("score"))
        held = scores.withColumn("moved", F.lit(0.0)).unionByName(flow.withColumn("moved", F.col("score")))
        scores = cut(held.groupBy("host").agg(F.sum("score").alias("score"), F.sum("moved").alias("moved")), "scores")
        # what a round hands on is what the one before brought
        # (a new host has moved by all of its score)
        if scores.agg(F.max(F.col("moved") / F.col("score"))).first()[0] <= tolerance:
            break
    return scores.select("host", "score")


def judge(pages: DataFrame, rules: Sequence[Rule], share: float = 0.5) -> DataFrame:
    """``page_id, host, path, rule, verdict, trust, distrust`` for every row of ``pages`` (``page_id, url, html``).

    A rule fits its host and all subdomains if the page's path starts with the
    rule's; the longest pattern wins, and of one pattern given twice, block.
    Other pages go by their host: blocked if it has distrust, and that is at
    least ``share`` of trust and distrust together, else allowed, however
    small both are. Seeds of trust are hosts with an allowed page that no rule blocks
    as a whole (path ``/``); those that are so blocked are seeds of distrust.

    A null or odd url has an empty host and path and is allowed, like any host
    without links to seeds. Rows that repeat are judged alike, each; rows with
    a null ``page_id`` too. Other columns of ``pages`` are not read.
    """
    spark = pages.sparkSession
    urls = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    given: dict[str, str] = {}
    for r in rules:
        given[r.pattern] = "block" if "block" in (r.verdict, given.get(r.pattern)) else r.verdict
    known = spark.createDataFrame(
        [(p, v, p.partition("/")[0].lower(), "/" + p.partition("/")[2]) for p, v in given.items()],
        "rule string, rule_verdict string, rule_host string, rule_path string",
    )
    # the rules of a host are those of its suffixes
    labels = F.split("host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), ".")
    )
    hosts = urls.select("host").distinct()
    fitting = (
        hosts.select("host", F.explode(suffixes).alias("rule_host"))
        .join(known, "rule_host")
        .groupBy("host")
        .agg(F.collect_list(F.struct(F.length("rule").alias("size"), "rule", "rule_path", "rule_verdict")).alias("fit"))
    )
    blocked = F.exists("fit", lambda r: (r["rule_path"] == "/") & (r["rule_verdict"] == "block"))
    ruled = cut(fitting.select("host", "fit", blocked.alias("blocked")), "ruled-hosts")

    best = F.array_max(F.filter("fit", lambda r: F.col("path").startswith(r["rule_path"])))
    allowed = urls.join(ruled.filter("not blocked"), "host").filter(best["rule_verdict"] == "allow")
    edges = cut(host_links(pages), "host-links")
    back = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "n")
    trust = propagate(edges, allowed.select("host").distinct()).withColumnRenamed("score", "trust")
    distrust = propagate(back, ruled.filter("blocked").select("host")).withColumnRenamed("score", "distrust")
    judged = (
        trust.join(distrust, "host", "full")
        .join(ruled.select("host", "fit"), "host", "full")
        .select("host", "fit", *[F.coalesce(c, F.lit(0.0)).alias(c) for c in ("trust", "distrust")])
    )
    zero = F.lit(0.0)
    held = urls.join(judged, "host", "left").withColumns(
        {"best": best, "trust": F.coalesce("trust", zero), "distrust": F.coalesce("distrust", zero)}
    )
    bad = (F.col("distrust") > 0) & (F.col("distrust") >= share * (F.col("trust") + F.col("distrust")))
    verdict = F.coalesce(F.col("best")["rule_verdict"], F.when(bad, "block").otherwise("allow"))
    return held.select(
        "page_id", "host", "path", F.col("best")["rule"].alias("rule"), verdict.alias("verdict"), "trust", "distrust"
    )
