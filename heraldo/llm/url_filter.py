"""URL filters: rules, and link-graph propagation for what no rule decides.

Rules name a host (with its subdomains) and a path prefix; the longest that fits decides. For other pages the host does:
personalised PageRank walks edges forward from trusted seeds (hosts of allowed pages), and walks them backward from
blocked seeds, so that who links to blocked hosts is distrusted. Seed mass is a host's number of allowed or blocked
pages. A host is blocked if distrust is at least SHARE of its whole mass, else allowed.

Edges are links between hosts, with their counts, and one either way between a host and its parent domain, down to two
labels: what owns a host answers for it, and the other way round. So hosts without absolute links are reached too.

Mass spreads in rounds: each round moves what the last one brought, DAMPING of it, along the edges. Where it ends at a host
without edges it would go back to the seeds; that only scales a walk's result, so it is scaled to the seeds' mass at the
end instead. After ROUNDS rounds less than DAMPING ** ROUNDS of the mass is still under way.

The two walks run as one table (walk, host, mass) joined to one edge table. Edges are distinct host pairs with link
counts, aggregated before any shuffle of whole pages; a host with a third of all links is one row per neighbour.

Defined cases: a null url, or one without ://, has empty host and path and no rule; null html has no links; links to the
page's own host and relative links are no edges; without edges or seeds masses are the seeds'; a page_id may repeat, its
rows are judged one by one; ties between rules of equal length go to block; an empty table gives no rows; of a very long
html its links are all that is kept; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower, persisted, table

#: (verdict, host, path prefix)
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]
DAMPING, ROUNDS, SHARE = 0.85, 20, 0.75
EDGES_A_TASK = 500_000
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_LINK = r"""(?i)\bhref\s*=\s*["']?\s*(?:https?:)?//([^/"'?#\s>]+)"""


def host_of(url: Column) -> Column:
    return F.coalesce(ascii_lower(F.regexp_extract(url, _URL, 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def matched(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """struct(rule, verdict) of the longest rule that fits, or null. Rules are few and become one expression."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule_host, prefix in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[0] == "block")):
        fits = ((host == rule_host) | host.endswith(f".{rule_host}")) & path.startswith(prefix)
        out = F.when(fits, F.struct(F.lit(rule_host + prefix).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def host_edges(pages: DataFrame) -> DataFrame:
    """(src, dst, links) between different hosts."""
    links = pages.select(host_of(F.col("url")).alias("src"), F.explode(F.regexp_extract_all("html", F.lit(_LINK), F.lit(1))).alias("dst"))
    return links.select("src", ascii_lower(F.col("dst")).alias("dst")).where("src <> '' and src <> dst").groupBy("src", "dst").agg(F.count("*").alias("links"))


def domain_edges(hosts: DataFrame) -> DataFrame:
    """(src, dst, links): one link either way between each host (host) and its parent domain, down to two labels."""
    labels = F.split("host", r"\.")
    name = lambda i: F.concat_ws(".", F.slice(labels, i, F.size(labels)))
    pairs = F.transform(F.sequence(F.lit(1), F.size(labels) - 2), lambda i: F.struct(name(i).alias("src"), name(i + 1).alias("dst")))
    up = hosts.where(F.size(labels) > 2).select(F.explode(pairs).alias("p")).select("p.src", "p.dst").distinct()
    return up.unionByName(up.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).withColumn("links", F.lit(1).cast("long"))


def propagate(edges: DataFrame, seeds: DataFrame, damping: float = DAMPING, rounds: int = ROUNDS) -> DataFrame:
    """(walk, host, mass): personalised PageRank over edges (walk, src, dst, links) from seeds (walk, host, mass)."""
    out = edges.groupBy("walk", "src").agg(F.sum("links").alias("total"))
    steps = persisted(edges.join(out, ["walk", "src"]).select("walk", "src", "dst", (F.col("links") / F.col("total")).alias("part")), "steps")
    state = seeds.select("walk", "host", "mass", F.col("mass").alias("fresh"))
    tasks = 1 + steps.count() // EDGES_A_TASK  # a round of a small graph needn't be dealt out widely
    for _ in range(rounds):
        moving = state.where("fresh > 0")
        sent = moving.join(steps, (moving["host"] == steps["src"]) & (moving["walk"] == steps["walk"])).select(moving["walk"], F.col("dst").alias("host"), (damping * F.col("fresh") * F.col("part")).alias("mass"))
        rows = state.select("walk", "host", "mass", F.lit(0.0).alias("fresh")).unionByName(sent.withColumn("fresh", F.col("mass")))
        state = persisted(rows.groupBy("walk", "host").agg(F.sum("mass").alias("mass"), F.sum("fresh").alias("fresh")).coalesce(tasks), "mass")
        if not state.where("fresh > 0").limit(1).count():
            break
    whole = seeds.groupBy("walk").agg(F.sum("mass").alias("all")).join(state.groupBy("walk").agg(F.sum("mass").alias("spread")), "walk")
    return state.join(whole, "walk").select("walk", "host", (F.col("mass") * F.col("all") / F.col("spread")).alias("mass"))


def judge(pages: DataFrame, rules: list[tuple[str, str, str]]) -> DataFrame:
    """(page_id, host, path, rule, verdict, trust, distrust) for every row of pages (page_id, url, html)."""
    parsed = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")).withColumn("m", matched(F.col("host"), F.col("path"), rules))
    parsed = persisted(parsed.select("page_id", "host", "path", "m.rule", "m.verdict"), "pages")
    seeds = parsed.where("verdict is not null").groupBy(F.when(F.col("verdict") == "allow", "trust").otherwise("distrust").alias("walk"), "host").agg(F.count("*").cast("double").alias("mass"))
    seeds = persisted(seeds, "seeds")
    links = persisted(host_edges(pages), "links")
    hosts = parsed.select("host").union(links.select("dst")).distinct()
    edges = persisted(links.unionByName(domain_edges(hosts)).groupBy("src", "dst").agg(F.sum("links").alias("links")), "edges")
    both = edges.select(F.lit("trust").alias("walk"), "src", "dst", "links").unionByName(edges.select(F.lit("distrust").alias("walk"), F.col("dst").alias("src"), F.col("src").alias("dst"), "links"))
    mass = propagate(both, seeds)
    of_host = mass.groupBy("host").agg(*(F.coalesce(F.sum(F.when(F.col("walk") == w, F.col("mass"))), F.lit(0.0)).alias(w) for w in ("trust", "distrust")))
    blocked = (F.col("distrust") > 0) & (F.col("distrust") >= SHARE * (F.col("trust") + F.col("distrust")))
    out = parsed.join(of_host, "host", "left")
    return out.select("page_id", "host", "path", "rule", F.coalesce("verdict", F.when(blocked, "block").otherwise("allow")).alias("verdict"), F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"))


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"), RULES).drop("trust", "distrust")


_FITS = " ".join(f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{v} {h}{p}'" for v, h, p in sorted(RULES, key=lambda r: (-len(r[1] + r[2]), r[0] != "block")))
#: The contract in SQL, with the rounds of the propagation as a recursion.
OP1_SQL = rf"""
WITH RECURSIVE u AS (SELECT page_id, html, regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)([^?#]*)', 1) AS h, regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)([^?#]*)', 2) AS path FROM pages),
p AS (SELECT page_id, html, translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, path FROM u),
r AS (SELECT page_id, host, path, CASE {_FITS} END AS rule FROM p),
k AS (SELECT host AS src, translate(unnest(regexp_extract_all(html, '(?i)href\s*=\s*["'']?\s*(?:https?:)?//([^/"''?#\s>]+)', 1)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS dst FROM p),
links AS (SELECT src, dst, count(*) AS links FROM k WHERE src <> '' AND src <> dst GROUP BY 1, 2),
hosts AS (SELECT host, string_split(host, '.') AS ls FROM (SELECT host FROM p UNION SELECT dst FROM links)),
up AS (SELECT DISTINCT array_to_string(list_slice(ls, i, len(ls)), '.') AS src, array_to_string(list_slice(ls, i + 1, len(ls)), '.') AS dst FROM (SELECT ls, unnest(range(1, greatest(len(ls) - 1, 1))) AS i FROM hosts)),
e AS (SELECT src, dst, sum(links) AS links FROM (SELECT * FROM links UNION ALL SELECT src, dst, 1 FROM up UNION ALL SELECT dst, src, 1 FROM up) GROUP BY 1, 2),
b AS (SELECT 'allow' AS walk, src, dst, links FROM e UNION ALL SELECT 'block', dst, src, links FROM e),
steps AS (SELECT walk, src, dst, links / sum(links) OVER (PARTITION BY walk, src) AS part FROM b),
seeds AS (SELECT split_part(rule, ' ', 1) AS walk, host, CAST(count(*) AS DOUBLE) AS mass FROM r WHERE rule IS NOT NULL GROUP BY 1, 2),
s AS (SELECT 0 AS round, walk, host, mass FROM seeds UNION ALL
  SELECT s.round + 1, s.walk, t.dst, {DAMPING} * sum(s.mass * t.part) FROM s JOIN steps t ON t.walk = s.walk AND t.src = s.host WHERE s.round < {ROUNDS} GROUP BY 1, 2, 3),
m AS (SELECT host, walk, sum(mass) AS mass FROM s GROUP BY 1, 2),
w AS (SELECT walk, (SELECT sum(mass) FROM seeds d WHERE d.walk = m.walk) / sum(mass) AS scale FROM m GROUP BY 1),
d AS (SELECT host, coalesce(sum(mass * scale) FILTER (walk = 'block'), 0) AS bad, coalesce(sum(mass * scale) FILTER (walk = 'allow'), 0) AS good FROM m JOIN w USING (walk) GROUP BY 1)
SELECT page_id, r.host, path, split_part(rule, ' ', 2) AS rule, coalesce(split_part(rule, ' ', 1), CASE WHEN bad > 0 AND bad >= {SHARE} * (good + bad) THEN 'block' ELSE 'allow' END) AS verdict
FROM r LEFT JOIN d ON d.host = r.host
"""
