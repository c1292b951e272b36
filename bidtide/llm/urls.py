"""URL filter: rules by host and path, and link-graph propagation for hosts without a rule. Expressions only.

Trust flows from hosts with allowed pages along links (personalised PageRank); distrust flows from hosts with blocked
pages against the links' direction, to those who link to them. Scores of a kind sum to 1 over all hosts. A host without a rule's
verdict is blocked when distrust is more than ``share`` of the trust and distrust that have reached it: a threshold per host that
depends neither on the size of the table nor on how many pages either set of seeds has.

Links are counted per pair of hosts before anything else, so a host with a third of all pages is one row per linked
host. Mass at hosts without outgoing links returns to the seeds. Each step is one join and one grouped sum over host pairs;
every few steps the scores are written to the shared folder, which cuts the plan and survives lost executors.

Defined results: a null url or one without ``://`` has an empty host and path and no rule, and is allowed; links of a
host to itself don't count; repeated pages count once for each row; hosts that are only linked to take part but get no
rows; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bidtide.session import written

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]
_LINK = r"""(?i)href\s*+=\s*+["']?(?:[a-z][a-z0-9+.-]*+:)?//([^/?#"'\s>]++)"""


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s).*?://([^/?#]*)", 1), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s).*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """(rule, verdict) of the longest rule that fits, or null. Rules are a short list given by the caller."""
    longest_first = sorted(rules, key=lambda r: -len(r[0] + r[1]))
    fits = [F.when(((host == h) | host.endswith(f".{h}")) & path.startswith(p), F.struct(F.lit(h + p).alias("rule"), F.lit(v).alias("verdict"))) for h, p, v in longest_first]
    return F.coalesce(*fits, F.lit(None).cast("struct<rule:string,verdict:string>"))


def host_links(pages: DataFrame) -> DataFrame:
    """src, dst, n: how many links lead from one host to another."""
    target = F.explode(F.regexp_extract_all("html", F.lit(_LINK), F.lit(1)))
    links = pages.where(F.col("html").rlike(_LINK)).select(host_of(F.col("url")).alias("src"), target.alias("dst"))
    return links.withColumn("dst", F.translate("dst", _UPPER, _LOWER)).where("src <> '' and dst <> '' and src <> dst").groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n"))


def propagated(links: DataFrame, seeds: DataFrame, damping: float = 0.85, steps: int = 20, every: int = 5) -> DataFrame:
    """kind, host, score after ``steps`` rounds. ``seeds``: kind, host, seed (of a kind they sum to 1). ``links``: kind,
    src, dst, share (of a source they sum to 1); sources without a row send their mass back to the seeds."""
    scores = seeds.select("kind", "host", F.col("seed").alias("score"))
    if links.isEmpty():
        return scores
    links, seeds = written(links, "links"), written(seeds, "seeds")
    for step in range(steps):
        flow = scores.withColumnRenamed("host", "src").join(links, ["kind", "src"])
        came = flow.groupBy("kind", F.col("dst").alias("host")).agg((damping * F.sum(F.col("score") * F.col("share"))).alias("score"))
        kept = came.groupBy("kind").agg(F.sum("score").alias("moved"))
        back = seeds.join(F.broadcast(kept), "kind", "left").select("kind", "host", (F.col("seed") * (1 - F.coalesce("moved", F.lit(0.0)))).alias("score"))
        scores = came.unionByName(back).groupBy("kind", "host").agg(F.sum("score").alias("score"))
        if step % every == every - 1:
            scores = written(scores, "scores")
    return scores


def host_scores(pages: DataFrame, rules: list[tuple[str, str, str]], **options) -> DataFrame:
    """host, trust, distrust for every host that some mass reaches."""
    judged = pages.select(host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    judged = judged.select("host", rule_of(F.col("host"), F.col("path"), rules)["verdict"].alias("verdict")).where("verdict is not null")
    kind = F.when(F.col("verdict") == "allow", "trust").otherwise("distrust").alias("kind")
    counts = written(judged.groupBy(kind, "host").agg(F.count(F.lit(1)).alias("n")), "seed_counts")
    totals = counts.groupBy("kind").agg(F.sum("n").alias("all"))  # two rows
    seeds = counts.join(F.broadcast(totals), "kind").select("kind", "host", (F.col("n") / F.col("all")).alias("seed"))
    pairs = written(host_links(pages), "host_links")

    def shares(kind: str, src: str, dst: str) -> DataFrame:
        out = pairs.groupBy(F.col(src).alias("src")).agg(F.sum("n").alias("all"))
        there = pairs.select(F.col(src).alias("src"), F.col(dst).alias("dst"), "n")
        return there.join(out, "src").select(F.lit(kind).alias("kind"), "src", "dst", (F.col("n") / F.col("all")).alias("share"))

    links = shares("trust", "src", "dst").unionByName(shares("distrust", "dst", "src"))
    scores = propagated(links, seeds, **options)
    of = lambda kind: F.sum(F.when(F.col("kind") == kind, F.col("score")).otherwise(0.0)).alias(kind)
    return scores.groupBy("host").agg(of("trust"), of("distrust"))


def judged_pages(pages: DataFrame, rules: list[tuple[str, str, str]] | None = None, share: float = 0.5, **options) -> DataFrame:
    """Every page: page_id, host, path, rule, verdict, trust, distrust (of its host)."""
    rules = RULES if rules is None else rules
    scores = host_scores(pages, rules, **options).withColumnRenamed("host", "scored")
    rows = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rows = rows.withColumn("fit", rule_of(F.col("host"), F.col("path"), rules))
    none = F.lit(0.0)
    at = rows.join(scores, F.col("host") == F.col("scored"), "left").select(
        "page_id", "host", "path", "fit", F.coalesce("trust", none).alias("trust"), F.coalesce("distrust", none).alias("distrust"))
    # A part in 10^9 keeps the order of summation out of the verdict.
    method = F.when(F.col("distrust") * (1 - 1e-9) > share * (F.col("trust") + F.col("distrust")), "block").otherwise("allow")
    return at.select("page_id", "host", "path", F.col("fit.rule").alias("rule"), F.coalesce("fit.verdict", method).alias("verdict"), "trust", "distrust")
