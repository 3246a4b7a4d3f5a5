"""Verdicts on URLs: rules, and trust and distrust that spread over the links between hosts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from surveylake.llm.common import table, written

#: Verdict, host and path of each rule.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
#: Rank is dealt out in whole units, so that sums do not depend on their order.
UNITS = 10**15
DAMPING_PCT = 85
#: Rounds of the SQL; `host_ranks` goes on until no rank changes.
ROUNDS = 8
#: A host is blocked if its share of distrust in trust and distrust is above this.
BLOCK_PCT = 50
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The host of a link that names one: after the scheme, or after // alone.
LINK = r"""(?i)\shref\s*=\s*["']?(?:[a-z][a-z0-9+.\-]*:)?//([^/?#"'<>\s]+)"""


def _after_scheme(url: Column) -> Column:
    at = F.locate("://", url)
    return F.coalesce(F.when(at > 0, F.substr(url, at + 3)), F.lit(""))


def with_rules(pages: DataFrame, rules=RULES, key: str = "page_id", url: str = "url") -> DataFrame:
    """`page_id`, `host`, `path`, `rule`, `ruled` of every row; host and path are empty for a null or odd URL.

    A rule fits its host and all below it if the path starts with the rule's. The longest wins, and a block over an
    allow of the same length.
    """
    rest = pages.select(F.col(key).alias("page_id"), _after_scheme(F.col(url)).alias("rest"))
    raw = F.regexp_extract("rest", "^[^/?#]*", 0)
    split = rest.select(
        "page_id",
        F.translate(raw, UPPER, LOWER).alias("host"),
        F.regexp_extract(F.substr("rest", F.length(raw) + 1), "^[^?#]*", 0).alias("path"),
    )
    rule = ruled = None
    for verdict, host, path in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[0] != "block")):
        fits = ((F.col("host") == host) | F.endswith("host", F.lit(f".{host}"))) & F.startswith("path", F.lit(path))
        rule = F.when(fits, host + path) if rule is None else rule.when(fits, host + path)
        ruled = F.when(fits, verdict) if ruled is None else ruled.when(fits, verdict)
    return split.select("*", rule.alias("rule"), ruled.alias("ruled"))


def host_edges(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """`source`, `target`, `links`: how many pages of a host link to another host."""
    raw = F.regexp_extract(_after_scheme(F.col(url)), "^[^/?#]*", 0)
    links = F.array_distinct(F.transform(F.regexp_extract_all(html, F.lit(LINK), 1), lambda h: F.translate(h, UPPER, LOWER)))
    pairs = pages.select(F.translate(raw, UPPER, LOWER).alias("source"), F.explode(links).alias("target"))
    pairs = pairs.where("source != '' and target != '' and source != target")
    return pairs.groupBy("source", "target").agg(F.count(F.lit(1)).alias("links"))


def host_ranks(ruled: DataFrame, edges: DataFrame) -> DataFrame:
    """`host`, `kind` (trust or distrust), `units`: personalised PageRank from ruled pages over the links.

    Trust starts at hosts with allowed pages and follows links; distrust starts at hosts with blocked pages and goes
    against them. Starts weigh as many pages as they have. Each round adds up, per host, its start and what its
    neighbours pass on, and is written to the shared folder. Rank that has no link to follow ends. Rounds start from
    less than any host ends with, so hosts and ranks only ever grow, and the last round is the one that changes neither
    the number of ranked hosts nor the sum of units; the driver sees these two numbers. Rows are one per host and link,
    never per page, and a host with many links is summed up in part by each task.
    """
    seeds = ruled.where("host != '' and ruled is not null").select(
        "host", F.when(F.col("ruled") == "allow", "trust").otherwise("distrust").alias("kind")
    )
    seeds = written(seeds.groupBy("kind", "host").agg(F.count(F.lit(1)).alias("pages")), "seeds")
    totals = seeds.groupBy("kind").agg(F.sum("pages").alias("total"))  # two rows
    start = seeds.join(F.broadcast(totals), "kind").select(
        "kind", "host", F.expr(f"cast(pages * cast({UNITS} as decimal(20,0)) div total as bigint)").alias("units")
    )
    start = written(start, "start")
    edges = written(edges, "host-edges")
    both = edges.select(F.lit("trust").alias("kind"), F.col("source").alias("host"), F.col("target").alias("to"), "links").unionByName(
        edges.select(F.lit("distrust").alias("kind"), F.col("target").alias("host"), F.col("source").alias("to"), "links")
    )
    out = both.groupBy("kind", "host").agg(F.sum("links").alias("out"))
    steps = written(both.join(out, ["kind", "host"]), "host-steps")
    rest = start.withColumn("units", F.expr(f"units * {100 - DAMPING_PCT} div 100"))
    ranks, before = written(rest, "ranks"), None
    while (now := ranks.agg(F.count(F.lit(1)), F.sum("units")).first()) != before:
        before = now
        passed = steps.join(ranks, ["kind", "host"]).select(
            "kind", F.col("to").alias("host"), F.expr(f"units * {DAMPING_PCT} div 100 div out * links").alias("units")
        )
        ranks = written(rest.unionByName(passed).groupBy("kind", "host").agg(F.sum("units").alias("units")), "ranks")
    return ranks


def blocked_hosts(ranks: DataFrame, block_pct: int = BLOCK_PCT) -> DataFrame:
    """Hosts whose share of distrust is above the threshold, or that distrust alone reaches, however small in units."""
    of = lambda kind: F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("units"))), F.lit(0)).alias(kind)
    hosts = ranks.groupBy("host").agg(of("trust"), of("distrust"), F.every(F.col("kind") == "distrust").alias("only"))
    share = F.col("distrust") * (100 - block_pct) > F.col("trust") * block_pct
    return hosts.where(share | F.col("only")).select("host")


def verdicts(pages: DataFrame, rules=RULES, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """`page_id`, `host`, `path`, `rule`, `verdict` of every row: the rule's verdict, else that of the host's ranks.

    Hosts without any rank, and the empty host, are allowed. Null or repeated keys are judged row by row. Blocked
    hosts are a written table, so that a join that does not broadcast them can split a hot host.
    """
    ruled = written(with_rules(pages, rules, key, url), "ruled-pages")
    blocked = written(blocked_hosts(host_ranks(ruled, host_edges(pages, url, html))), "blocked-hosts")
    found = ruled.join(blocked.withColumn("bad", F.lit("block")), "host", "left")
    return found.select("page_id", "host", "path", "rule", F.coalesce("ruled", "bad", F.lit("allow")).alias("verdict"))


def op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verdicts(table(spark, sf_dir, "pages"))


def _sql() -> str:
    ordered = sorted(RULES, key=lambda r: (-len(r[1] + r[2]), r[0] != "block"))
    fits = [(f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')", h + p, v) for v, h, p in ordered]
    rule = " ".join(f"WHEN {f} THEN '{r}'" for f, r, _ in fits)
    ruled = " ".join(f"WHEN {f} THEN '{v}'" for f, _, v in fits)
    link = LINK.replace("'", "''")
    low = f"translate({{}}, '{UPPER}', '{LOWER}')"
    ctes = f"""
rest AS (SELECT page_id, html, coalesce(CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END, '') AS rest FROM pages),
split AS (SELECT page_id, html, {low.format("regexp_extract(rest, '^[^/?#]*')")} AS host,
          regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path FROM rest),
ruled AS MATERIALIZED (SELECT page_id, html, host, path, CASE {rule} END AS rule, CASE {ruled} END AS ruled FROM split),
edges AS MATERIALIZED (SELECT source, target, count(*) AS links FROM (
  SELECT DISTINCT page_id, host AS source, {low.format("unnest(regexp_extract_all(html, '" + link + "', 1))")} AS target FROM ruled)
  WHERE source <> '' AND target <> '' AND source <> target GROUP BY ALL),
seeds AS (SELECT CASE ruled WHEN 'allow' THEN 'trust' ELSE 'distrust' END AS kind, host, count(*) AS pages
  FROM ruled WHERE host <> '' AND ruled IS NOT NULL GROUP BY ALL),
start AS MATERIALIZED (SELECT kind, host,
  (pages::HUGEINT * {UNITS} // sum(pages) OVER (PARTITION BY kind)::HUGEINT)::HUGEINT AS units FROM seeds),
both_ways AS (SELECT 'trust' AS kind, source AS host, target AS dest, links FROM edges
  UNION ALL SELECT 'distrust', target, source, links FROM edges),
steps AS MATERIALIZED (SELECT *, sum(links) OVER (PARTITION BY kind, host) AS outgoing FROM both_ways),
r0 AS (SELECT * FROM start)"""
    for n in range(ROUNDS):
        ctes += f""",
r{n + 1} AS MATERIALIZED (SELECT kind, host, sum(units)::HUGEINT AS units FROM (
  SELECT kind, host, units * {100 - DAMPING_PCT} // 100 AS units FROM start
  UNION ALL SELECT s.kind, s.dest, units * {DAMPING_PCT} // 100 // outgoing * links FROM steps s JOIN r{n} r ON r.kind = s.kind AND r.host = s.host)
  GROUP BY ALL)"""
    return f"""WITH {ctes},
blocked AS (SELECT host FROM r{ROUNDS} GROUP BY host HAVING coalesce(sum(units) FILTER (kind = 'distrust'), 0) * {100 - BLOCK_PCT}
  > coalesce(sum(units) FILTER (kind = 'trust'), 0) * {BLOCK_PCT})
SELECT page_id, host, path, rule,
       CASE WHEN ruled IS NOT NULL THEN ruled WHEN host IN (SELECT host FROM blocked) THEN 'block' ELSE 'allow' END AS verdict
FROM ruled"""


OP7_SQL = _sql()
