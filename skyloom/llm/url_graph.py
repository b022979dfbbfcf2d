"""URL filters with link-graph propagation, in DataFrame and SQL functions only.

A page's url is first held against rules (host, path, action): a rule fits its host and all subdomains where the url's
path starts with the rule's path; the longest rule wins. Urls without a rule get their host's verdict:

* Links between hosts come from the pages' absolute hrefs, counted once for each pair of hosts.
* Trust is personalised PageRank along the links, seeded at each host with the share of its pages that rules allow.
* Distrust is the same on the reversed links, seeded with the share that rules block: who links to blocked hosts is
  distrusted.
* A host without (reversed) links keeps its own seed. After `rounds` power iterations a host is blocked where its
  distrust reaches `threshold` and exceeds its trust.

Pages are reduced to (host, counts) and (host, host, links) before the walks, so that a host with a third of all pages
weighs one row there; html is read once, for its hrefs. Where pages meet what is known of their hosts, hosts with more
than a 1,000th of all pages (fewer than 1,000, whatever the size) are broadcast and only the rest is joined by host, so
that no task gets more than a 1,000th of the pages for one host.

Defined results: a null url, or one without ://, has empty host and path; empty hosts have neither rules nor links and
are allowed. Repeated pages count as often as they occur. Null html has no links. An empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyloom.llm.common import ascii_lower, cut, table

RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block"))
DAMPING = 0.85
ROUNDS = 12
THRESHOLD = 0.5
HOT = 1000
#: Absolute and scheme-relative targets.
HREF = r"""(?i)\bhref\s*=\s*["']?\s*((?:[a-z][a-z0-9+.-]*:)?//[^"'\s>]+)"""


def after_scheme(url: Column) -> Column:
    return F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.lit(2147483647))).otherwise("")


def host_of(url: Column) -> Column:
    return F.coalesce(ascii_lower(F.regexp_extract(after_scheme(url), r"(?s)^([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(after_scheme(url), r"(?s)^[^/?#]*([^?#]*)", 1), F.lit(""))


def suffixes(host: Column) -> Column:
    """a.b.c -> [a.b.c, b.c, c]"""
    parts = F.split(host, r"\.", -1)
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))


def rule_table(spark, rules) -> DataFrame:
    rows = [F.struct(F.lit(h).alias("suffix"), F.lit(p).alias("start"), F.lit(h + p).alias("rule"), F.lit(a).alias("action")) for h, p, a in rules]
    empty = F.array().cast("array<struct<suffix:string,start:string,rule:string,action:string>>")
    return spark.range(1).select(F.explode(F.array(*rows) if rows else empty).alias("r")).select("r.*")


def known(urls: DataFrame, hosts: DataFrame, hot: DataFrame) -> DataFrame:
    """urls with the columns of hosts(host, ...), null where there are none. hot(host): hosts with many urls, under HOT of them."""
    cold = urls.join(F.broadcast(hot), "host", "left_anti").join(hosts.join(F.broadcast(hot), "host", "left_anti"), "host", "left")
    few = F.broadcast(hot.join(hosts, "host", "left"))
    return cold.unionByName(urls.join(few, "host").select(cold.columns))


def many(urls: DataFrame) -> DataFrame:
    """host: those with more than a HOT-th of all urls."""
    counts = cut(urls.groupBy("host").agg(F.count("*").alias("n")))
    total = counts.agg(F.sum("n")).first()[0] or 0
    return cut(counts.filter(F.col("n") * HOT > total).select("host"))


def ruled(urls: DataFrame, rules: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """urls(host, path, ...) with rule and action, null where none fits. Rules are joined to distinct hosts, not to pages."""
    hot = many(urls) if hot is None else hot
    hosts = urls.select("host").distinct().withColumn("suffix", F.explode(suffixes(F.col("host"))))
    by_host = hosts.join(rules, "suffix").groupBy("host").agg(F.collect_list(F.struct(F.length("rule").alias("n"), "rule", "action", "start")).alias("__rules"))
    fit = F.array_max(F.filter(F.coalesce(F.col("__rules"), F.array().cast("array<struct<n:int,rule:string,action:string,start:string>>")), lambda r: F.startswith(F.col("path"), r["start"])))
    return known(urls, by_host, hot).withColumn("__fit", fit).withColumns({"rule": F.col("__fit.rule"), "action": F.col("__fit.action")}).drop("__rules", "__fit")


def links(pages: DataFrame) -> DataFrame:
    """from, to, n: links between different hosts."""
    target = F.when(F.startswith(F.col("href"), F.lit("//")), F.concat(F.lit("x:"), F.col("href"))).otherwise(F.col("href"))
    return (
        pages.select(host_of(F.col("url")).alias("from"), F.explode(F.regexp_extract_all("html", F.lit(HREF), 1)).alias("href"))
        .select("from", host_of(target).alias("to"))
        .filter((F.col("from") != "") & (F.col("to") != "") & (F.col("from") != F.col("to")))
        .groupBy("from", "to")
        .agg(F.count("*").alias("n"))
    )


def propagate(edges: DataFrame, seeds: DataFrame, damping: float = DAMPING, rounds: int = ROUNDS) -> DataFrame:
    """edges(from, to, n), seeds(host, trust, distrust) -> host, trust, distrust after the given rounds.

    Both walks run in one table keyed by (kind, host). Every round is a join and an aggregation; lineage is cut every
    fourth round.
    """
    both = edges.select(F.lit("t").alias("kind"), F.col("from").alias("host"), "to", "n").unionByName(edges.select(F.lit("d").alias("kind"), F.col("to").alias("host"), F.col("from").alias("to"), "n"))
    base = seeds.select("host", F.explode(F.array(F.struct(F.lit("t").alias("kind"), F.col("trust").alias("seed")), F.struct(F.lit("d").alias("kind"), F.col("distrust").alias("seed")))).alias("x")).select("x.kind", "host", "x.seed")
    out = both.groupBy("kind", "host").agg(F.sum("n").alias("all"))
    walk = both.join(out, ["kind", "host"]).select("kind", "host", "to", (F.col("n") / F.col("all")).alias("part"))
    stay = base.join(out, ["kind", "host"], "left_anti").select("kind", "host", F.col("host").alias("to"), F.lit(1.0).alias("part"))
    walk, base = cut(walk.unionByName(stay)), cut(base)
    rank = base.withColumnRenamed("seed", "rank")
    for i in range(rounds):
        moved = walk.join(rank, ["kind", "host"]).select("kind", F.col("to").alias("host"), (F.col("part") * F.col("rank") * damping).alias("rank"))
        rank = moved.unionByName(base.select("kind", "host", (F.col("seed") * (1 - damping)).alias("rank"))).groupBy("kind", "host").agg(F.sum("rank").alias("rank"))
        if i % 4 == 3:
            rank = cut(rank)
    pick = lambda kind: F.coalesce(F.max(F.when(F.col("kind") == kind, F.col("rank"))), F.lit(0.0))
    return rank.groupBy("host").agg(pick("t").alias("trust"), pick("d").alias("distrust"))


def judge(pages: DataFrame, rules=RULES, damping: float = DAMPING, rounds: int = ROUNDS, threshold: float = THRESHOLD) -> DataFrame:
    """page_id, host, path, rule, verdict, trust, distrust for every row of pages(page_id, url, html)."""
    urls = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    hot = many(urls)
    found = ruled(urls, rule_table(pages.sparkSession, rules), hot)
    counts = cut(found.groupBy("host").agg(F.avg(F.when(F.col("action") == "allow", 1.0).otherwise(0.0)).alias("trust"), F.avg(F.when(F.col("action") == "block", 1.0).otherwise(0.0)).alias("distrust")))
    edges = cut(links(pages))
    ends = reduce(DataFrame.unionByName, [counts, *(edges.select(F.col(c).alias("host"), F.lit(0.0).alias("trust"), F.lit(0.0).alias("distrust")) for c in ("from", "to"))])
    seeds = ends.groupBy("host").agg(F.max("trust").alias("trust"), F.max("distrust").alias("distrust"))
    scores = cut(propagate(edges, seeds, damping, rounds).join(counts.select("host"), "host", "left_semi"))
    by_graph = F.when((F.col("distrust") >= threshold) & (F.col("distrust") > F.col("trust")), "block").otherwise("allow")
    return known(found, scores, hot).select("page_id", "host", "path", "rule", F.coalesce("action", by_graph).alias("verdict"), F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"))


def op1_url_graph(spark, sf_dir):
    return judge(table(spark, sf_dir, "pages")).withColumns({c: F.round(c, 6) for c in ("trust", "distrust")})
