"""Operator 6: URL filter by link-graph propagation.

Rules judge the pages they fit.  The hosts of allowed pages are trusted seeds,
those of blocked pages are blocked seeds, each weighted by its pages.  Trust runs
along the host edges as personalised PageRank; distrust runs against them, from a
blocked host to the hosts that link to it.  Rounds go on until a walk has at most
``TOLERANCE`` of its mass still to move, whatever the graph; what reaches hosts
without edges starts again at the seeds, so both scores sum to 1.  A host's share
of distrust in both is held against a threshold, which judges its pages that no
rule fits.

Host edges: hyperlinks between pages of different hosts (absolute or protocol
relative), weighted by their number, and one edge each way between a host and
its parent domain (of two labels at least), so that mirrors such as ``www.`` and
``m.`` share a standing.  The graph has a row for each pair of hosts, aggregated
before it is shuffled; each round is one join and one sum on it.

All of it is built-in column functions.  Rules are constants, a few hundred at
most; hosts and edges are never collected.  Of the hosts only those of more than
one page in ``HOT`` are broadcast, so ``HOT`` at most: their pages are judged
where they are read, and only those of other hosts are shuffled.

Defined results: a null url, or one without ``://``, has an empty host and path;
pages of a host without trust and distrust are allowed; equal rules count once;
null page ids and repeated rows are kept row by row; extra columns are ignored;
an empty table gives an empty result.  Pages are read whole.
"""

from __future__ import annotations

import math
import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchlake.llm.common import cut, delete_folder, shared_folder

#: Host, path and verdict of each rule.
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)
DAMPING, TOLERANCE, BLOCK_SHARE = 0.85, 1e-3, 0.75
#: After r rounds at most DAMPING ** r of the mass is left to move.
ROUNDS = math.ceil(math.log(TOLERANCE) / math.log(DAMPING))
#: Host edges that one task may hold.
HOT, LOCAL = 1000, 200_000
#: Rounds between two tables of a larger graph's scores.
EVERY = 6
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LINK = r"""(?i)href\s*=\s*["']?(?:https?:)?//([^/?#"'\s>]+)"""


def host_path(url: Column) -> tuple[Column, Column]:
    has = F.coalesce(F.instr(url, "://") > 0, F.lit(False))
    rest = F.substring(url, F.instr(url, "://") + 3, F.length(url))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.when(has, host).otherwise(""), F.when(has, path).otherwise("")


def judged(pages: DataFrame, rules=RULES) -> DataFrame:
    """page_id, host, path, rule, said: the longest fitting rule and its verdict."""
    host, path = host_path(F.col("url"))
    df = pages.select("page_id", host.alias("host"), path.alias("path"), *[c for c in ("html",) if c in pages.columns])
    fits = []
    for h, p, verdict in sorted(rules, key=lambda r: (-len(r[0] + r[1]), r)):
        on = (F.col("host") == h) | F.col("host").endswith("." + h)
        fits.append(F.when(on & F.col("path").startswith(p), F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("said"))))
    best = F.coalesce(*fits)
    return df.withColumns({"rule": best["rule"], "said": best["said"]})


def edges_and_seeds(pages: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Edges (kind, src, dst, w) in both kinds, forward for trust and reversed
    for distrust, with the weights leaving a host summing to 1, and seeds
    (kind, host, seed), each kind summing to 1; and hosts with their pages."""
    links = (
        pages.where("host <> ''")
        .select(F.col("host").alias("a"), F.explode(F.regexp_extract_all("html", F.lit(LINK), 1)).alias("b"))
        .select("a", F.translate("b", UPPER, LOWER).alias("b"))
        .where("a <> b")
        .groupBy("a", "b")
        .agg(F.count(F.lit(1)).cast("double").alias("n"))
    )
    hosts = pages.where("host <> ''").groupBy("host").agg(
        F.count_if(F.col("said") == "allow").alias("allow"), F.count_if(F.col("said") == "block").alias("block"), F.count(F.lit(1)).alias("pages")
    )
    hosts = cut(hosts)
    links = cut(links)
    names = hosts.select("host").union(links.select("b"))
    labels = F.split("host", r"\.")
    ancestors = F.transform(
        F.sequence(F.lit(1), F.size("l") - 1), lambda i: F.array_join(F.slice("l", i, F.size("l")), ".")
    )
    parents = (
        names.withColumn("l", labels)
        .where("size(l) > 2")
        .select(F.explode(F.arrays_zip(F.slice(ancestors, 1, F.size("l") - 2).alias("a"), F.slice(ancestors, 2, F.size("l") - 2).alias("b"))).alias("p"))
        .select("p.a", "p.b")
        .distinct()
    )
    both = parents.unionByName(parents.select(F.col("b").alias("a"), F.col("a").alias("b"))).withColumn("n", F.lit(1.0))
    graph = links.unionByName(both).groupBy("a", "b").agg(F.sum("n").alias("n"))
    directed = graph.select(F.lit("trust").alias("kind"), F.col("a").alias("src"), F.col("b").alias("dst"), "n").unionByName(
        graph.select(F.lit("distrust").alias("kind"), F.col("b").alias("src"), F.col("a").alias("dst"), "n")
    )
    leaving = directed.groupBy("kind", "src").agg(F.sum("n").alias("all"))
    edges = directed.join(leaving, ["kind", "src"]).select("kind", "src", "dst", (F.col("n") / F.col("all")).alias("w"))
    counts = hosts.select(
        "host", F.explode(F.array(F.struct(F.lit("trust").alias("kind"), F.col("allow").alias("n")), F.struct(F.lit("distrust").alias("kind"), F.col("block").alias("n")))).alias("x")
    ).select("host", "x.*").where("n > 0")
    total = counts.groupBy("kind").agg(F.sum("n").alias("all"))
    seeds = counts.join(F.broadcast(total), "kind").select("kind", "host", (F.col("n") / F.col("all")).alias("seed"))
    return cut(edges), cut(seeds), hosts.select("host", "pages")


def standing(edges: DataFrame, seeds: DataFrame, damping: float = DAMPING, rounds: int = ROUNDS) -> DataFrame:
    """host, trust, distrust after so many rounds, each summing to 1: a host without
    edges hands its mass back to the seeds, which only scales the scores of all."""
    # A graph that one task holds (counted) is walked there, without a shuffle.  Of a larger
    # one the edges are dealt by source once, so a round moves scores only; every few
    # rounds those are written and the table before is removed.
    spark, few = edges.sparkSession, edges.count() <= LOCAL
    together = lambda df: df.coalesce(1) if few else df
    edges = together(edges) if few else cut(edges.repartition("kind", "src"))
    folder, last = f"{shared_folder(spark)}/walk-{uuid.uuid4().hex}", None
    start = seeds.select("kind", "host", (F.col("seed") * (1 - damping)).alias("score"))
    rank = together(seeds.select("kind", "host", F.col("seed").alias("score")))
    for i in range(rounds):
        moved = rank.withColumnRenamed("host", "src").join(edges, ["kind", "src"]).select(
            "kind", F.col("dst").alias("host"), (F.col("score") * F.col("w") * damping).alias("score")
        )
        rank = together(moved.unionByName(start)).groupBy("kind", "host").agg(F.sum("score").alias("score"))
        if few and i % 4 == 3 and i + 1 < rounds:
            rank = together(cut(rank))
        elif not few and i % EVERY == EVERY - 1 and i + 1 < rounds:
            rank.write.parquet(f"{folder}/{i}")
            rank = spark.read.schema(rank.schema).parquet(f"{folder}/{i}")
            if last is not None:
                delete_folder(spark, f"{folder}/{last}")
            last = i
    rank = cut(rank)
    delete_folder(spark, folder)
    whole = rank.groupBy("kind").agg(F.sum("score").alias("all"))  # two rows
    rank = rank.join(F.broadcast(whole), "kind").select("kind", "host", (F.col("score") / F.col("all")).alias("score"))
    of = lambda kind: F.sum(F.when(F.col("kind") == kind, F.col("score")).otherwise(0.0)).alias(kind)
    return rank.groupBy("host").agg(of("trust"), of("distrust"))


def filter_urls(pages: DataFrame, rules=RULES, share: float = BLOCK_SHARE) -> DataFrame:
    """page_id, host, path, rule, verdict, distrust_share."""
    edges, seeds, sizes = edges_and_seeds(judged(pages.select("page_id", "url", "html"), rules))
    part = F.round(F.col("distrust") / (F.col("trust") + F.col("distrust")), 9)
    hosts = cut(sizes.join(standing(edges, seeds).select("host", part.alias("distrust_share")), "host", "full"))
    total = hosts.agg(F.coalesce(F.sum("pages"), F.lit(0))).first()[0]
    hot = F.broadcast(hosts.where(F.col("pages") > total / HOT).drop("pages"))
    plain = judged(pages.select("page_id", "url"), rules)
    near = plain.join(hot, "host")
    far = plain.join(hot.select("host"), "host", "left_anti").join(hosts.drop("pages"), "host", "left")
    bad = F.coalesce(F.col("distrust_share") >= share, F.lit(False))
    return near.unionByName(far).select(
        "page_id", "host", "path", "rule", F.coalesce("said", F.when(bad, "block").otherwise("allow")).alias("verdict"),
        F.coalesce("distrust_share", F.lit(0.0)).alias("distrust_share"),
    )


def oracle(rules=RULES, damping: float = DAMPING, rounds: int = ROUNDS, share: float = BLOCK_SHARE) -> str:
    fits = "\n".join(
        f"    WHEN (host = '{h}' OR ENDS_WITH(host, '.{h}')) AND STARTS_WITH(path, '{p}') THEN ['{h + p}', '{v}']"
        for h, p, v in sorted(rules, key=lambda r: (-len(r[0] + r[1]), r))
    )
    steps = "".join(
        f"""
r{i + 1} AS MATERIALIZED (SELECT kind, host, SUM(score) AS score FROM (
  SELECT e.kind, e.dst AS host, score * w * {damping} AS score FROM r{i} r JOIN e ON r.kind = e.kind AND r.host = e.src
  UNION ALL SELECT kind, host, seed * {1 - damping} FROM seeds) GROUP BY kind, host),"""
        for i in range(rounds)
    )
    return rf"""
WITH u AS (SELECT page_id, html, CASE WHEN CONTAINS(COALESCE(url, ''), '://') THEN SUBSTR(url, INSTR(url, '://') + 3) ELSE '' END AS rest FROM pages),
hp AS (SELECT page_id, html, TRANSLATE(REGEXP_EXTRACT(rest, '^([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host,
  REGEXP_EXTRACT(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
j AS MATERIALIZED (SELECT *, fit[1] AS rule, fit[2] AS said FROM (SELECT *, CASE
{fits}
    END AS fit FROM hp)),
links AS (SELECT a, b, CAST(COUNT(*) AS DOUBLE) AS n FROM (SELECT host AS a,
  TRANSLATE(UNNEST(REGEXP_EXTRACT_ALL(html, '{LINK.replace("'", "''")}', 1)), '{UPPER}', '{LOWER}') AS b FROM j WHERE host <> '') WHERE a <> b GROUP BY a, b),
names AS (SELECT host FROM j WHERE host <> '' UNION SELECT b FROM links),
split AS (SELECT STRING_SPLIT(host, '.') AS l FROM names),
parents AS (SELECT DISTINCT ARRAY_TO_STRING(l[i:], '.') AS a, ARRAY_TO_STRING(l[i + 1:], '.') AS b
  FROM (SELECT l, UNNEST(RANGE(1, LEN(l) - 1)) AS i FROM split WHERE LEN(l) > 2)),
graph AS (SELECT a, b, SUM(n) AS n FROM (SELECT * FROM links UNION ALL SELECT a, b, 1.0 FROM parents UNION ALL SELECT b, a, 1.0 FROM parents) GROUP BY a, b),
d AS (SELECT 'trust' AS kind, a AS src, b AS dst, n FROM graph UNION ALL SELECT 'distrust', b, a, n FROM graph),
e AS MATERIALIZED (SELECT kind, src, dst, n / SUM(n) OVER (PARTITION BY kind, src) AS w FROM d),
seeds AS MATERIALIZED (SELECT kind, host, n / SUM(n) OVER (PARTITION BY kind) AS seed FROM (
  SELECT CASE said WHEN 'allow' THEN 'trust' ELSE 'distrust' END AS kind, host, CAST(COUNT(*) AS DOUBLE) AS n FROM j
  WHERE said IS NOT NULL AND host <> '' GROUP BY 1, 2)),
r0 AS (SELECT kind, host, seed AS score FROM seeds),{steps}
z AS MATERIALIZED (SELECT kind, host, score / SUM(score) OVER (PARTITION BY kind) AS score FROM r{rounds}),
s AS (SELECT host, ROUND(SUM(CASE WHEN kind = 'distrust' THEN score ELSE 0.0 END) / SUM(score), 9) AS distrust_share FROM z GROUP BY host)
SELECT page_id, j.host AS host, path, rule,
  COALESCE(said, CASE WHEN distrust_share >= {share} THEN 'block' ELSE 'allow' END) AS verdict,
  COALESCE(distrust_share, 0.0) AS distrust_share
FROM j LEFT JOIN s ON s.host = j.host
"""
