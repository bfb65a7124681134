"""URL filter by rules and link-graph propagation (operator 9), DataFrame
functions only.

A url's host and path are judged by the rules first (the longest rule that
fits wins).  Urls that no rule fits get their host's verdict from the method:
trust flows from hosts whose pages a rule allows along host edges
(personalised PageRank), distrust flows from hosts whose pages a rule blocks
against the edges' direction (to the hosts that link there); a host with more
distrust than trust is blocked.

Host edges: absolute links in the pages' html, with or without a scheme, and
both ways between a host and the domain right above it (blog.a.example and
a.example), for hosts of more than two labels.  Masses are integers, so sums
don't depend on the order of rows; mass at a host without edges is dropped.
The host table and the edges are Spark tables at every size.

Masses are counted in 10^-18 of a page, each share rounded down, and moved on
for ``STEPS`` steps, until less than a thousandth of all mass is under way;
``trust`` and ``distrust`` give them as decimal text.

Defined results: null urls or urls without ``://`` have an empty host and
path, no rule, and the verdict of a host without edges (allow); null html has
no links; repeated pages count as often as they stand there; an empty table
gives an empty result; other columns of the input are ignored.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from relevo.llm.common import table
from relevo.session import materialize

NAME = "op9_url_filters"
#: (host, path, verdict)
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
#: Per cent of a host's mass that moves along its edges in a step; after the
#: steps less than a thousandth of all mass is under way.
DAMPING, STEPS = 85, 43
#: Parts of a page's mass.
UNIT = 10**18
LINK = r"""(?:href|src)\s*=\s*["']?(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#"'\s<>]+)"""
_MASS = "decimal(38,0)"


def _ascii_lower(c: Column) -> Column:
    return F.translate(c, string.ascii_uppercase, string.ascii_lowercase)


def host_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    return _ascii_lower(F.regexp_extract(rest, r"^[^/?#]*", 0)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def matched_rule(host: Column, path: Column, rules) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else null."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, h + p).otherwise(rule), F.when(fits, v).otherwise(verdict)
    return rule, verdict


def host_edges(pages: DataFrame, hosts: DataFrame) -> DataFrame:
    """Distinct ``src, dst`` pairs of different hosts."""
    links = pages.select(
        F.col("host").alias("src"),
        F.explode(F.array_distinct(F.transform(F.regexp_extract_all("html", F.lit(LINK), 1), _ascii_lower))).alias("dst"),
    )
    above = hosts.select(F.col("host").alias("src"), F.regexp_extract("host", r"^[^.]+\.(.+\..+)$", 1).alias("dst"))
    below = above.select(F.col("dst").alias("src"), F.col("src").alias("dst"))
    return links.unionByName(above).unionByName(below).filter("src <> '' and dst <> '' and src <> dst").distinct()


def propagate(hosts: DataFrame, edges: DataFrame, steps: int = STEPS) -> DataFrame:
    """``host, trust, distrust`` from seeds of the same columns over ``src,
    dst`` edges.  A step's table is written to the shared folder, so the plan
    doesn't grow with the steps."""
    out_deg = edges.groupBy("src").agg(F.count(F.lit(1)).alias("deg"))
    in_deg = edges.groupBy("dst").agg(F.count(F.lit(1)).alias("deg"))
    ahead = edges.join(out_deg, "src").select(F.col("src").alias("host"), F.col("dst").alias("to"), F.col("deg").alias("fwd"), F.lit(None).cast("long").alias("back"))
    against = edges.join(in_deg, "dst").select(F.col("dst").alias("host"), F.col("src").alias("to"), F.lit(None).cast("long").alias("fwd"), F.col("deg").alias("back"))
    arcs = materialize(ahead.unionByName(against), "url-arcs")
    if arcs.isEmpty():
        return hosts
    whole = lambda x: F.expr(f"cast(coalesce(floor({x}), 0) as {_MASS})")
    share = lambda mass, deg: whole(f"{mass} * {DAMPING} / cast({deg} * 100 as decimal(20,0))")
    seeds = hosts.select("host", *[whole(f"{c} * {100 - DAMPING} / 100").alias(c) for c in ("trust", "distrust")])
    state = hosts
    for _ in range(steps):
        moved = arcs.join(state, "host").select(F.col("to").alias("host"), share("trust", "fwd").alias("trust"), share("distrust", "back").alias("distrust"))
        sums = moved.unionByName(seeds).groupBy("host").agg(*[F.sum(c).cast(_MASS).alias(c) for c in ("trust", "distrust")])
        state = materialize(sums, "url-mass")
    return state


def filter_urls(pages: DataFrame, rules=RULES, steps: int = STEPS) -> DataFrame:
    """``page_id, host, path, rule, verdict, trust, distrust`` for every page."""
    host, path = host_path(F.col("url"))
    split = pages.select("page_id", host.alias("host"), path.alias("path"), "html")
    rule, verdict = matched_rule(F.col("host"), F.col("path"), rules)
    judged = materialize(split.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("ruled")), "url-rules")
    seeds = judged.groupBy("host").agg(
        *[(F.count_if(F.col("ruled") == verdict).cast(_MASS) * F.lit(UNIT).cast("decimal(19,0)")).cast(_MASS).alias(c) for c, verdict in (("trust", "allow"), ("distrust", "block"))]
    )
    seeds = materialize(seeds.filter("host <> ''"), "url-seeds")
    mass = propagate(seeds, host_edges(split, seeds), steps)
    return judged.join(mass, "host", "left").select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("ruled", F.when(F.col("distrust") > F.col("trust"), "block").otherwise("allow")).alias("verdict"),
        *[F.coalesce(F.col(c).cast("string"), F.lit("0")).alias(c) for c in ("trust", "distrust")],
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages"))


def _oracle() -> str:
    lower = f"translate({{}}, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
    rule = verdict = "NULL"
    for h, p, v in sorted(RULES, key=lambda r: len(r[0] + r[1])):
        fits = f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')"
        rule, verdict = f"CASE WHEN {fits} THEN '{h + p}' ELSE {rule} END", f"CASE WHEN {fits} THEN '{v}' ELSE {verdict} END"
    link = LINK.replace("'", "''")
    steps = ["m0 AS (SELECT * FROM seeds)"]
    for i in range(STEPS):
        steps.append(f"""m{i + 1} AS MATERIALIZED (SELECT host, sum(trust)::HUGEINT AS trust, sum(distrust)::HUGEINT AS distrust FROM (
          SELECT dst AS host, trust * {DAMPING} // (100 * od) AS trust, 0::HUGEINT AS distrust FROM arcs JOIN m{i} ON host = src
          UNION ALL SELECT src, 0, distrust * {DAMPING} // (100 * id) FROM arcs JOIN m{i} ON host = dst
          UNION ALL SELECT host, trust * {100 - DAMPING} // 100, distrust * {100 - DAMPING} // 100 FROM seeds
          WHERE EXISTS (SELECT 1 FROM arcs)
          UNION ALL SELECT host, trust, distrust FROM seeds WHERE NOT EXISTS (SELECT 1 FROM arcs)) GROUP BY host)""")
    return f"""
WITH r AS (SELECT page_id, html, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
s AS (SELECT page_id, html, {lower.format("regexp_extract(rest, '^[^/?#]*', 0)")} AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM r),
j AS (SELECT page_id, html, host, path, {rule} AS rule, {verdict} AS ruled FROM s),
seeds AS MATERIALIZED (SELECT host, {UNIT}::HUGEINT * count(*) FILTER (ruled = 'allow') AS trust, {UNIT}::HUGEINT * count(*) FILTER (ruled = 'block') AS distrust
  FROM j WHERE host <> '' GROUP BY host),
above AS (SELECT host AS src, regexp_extract(host, '^[^.]+\\.(.+\\..+)$', 1) AS dst FROM seeds),
edges AS MATERIALIZED (SELECT DISTINCT src, dst FROM (
  SELECT host AS src, {lower.format("unnest(regexp_extract_all(html, '" + link + "', 1))")} AS dst FROM j
  UNION ALL SELECT src, dst FROM above UNION ALL SELECT dst, src FROM above) WHERE src <> '' AND dst <> '' AND src <> dst),
arcs AS MATERIALIZED (SELECT src, dst, count(*) OVER (PARTITION BY src) AS od, count(*) OVER (PARTITION BY dst) AS id FROM edges),
{", ".join(steps)}
SELECT page_id, host, path, rule, coalesce(ruled, CASE WHEN distrust > trust THEN 'block' ELSE 'allow' END) AS verdict,
  coalesce(trust, 0)::VARCHAR AS trust, coalesce(distrust, 0)::VARCHAR AS distrust
FROM j LEFT JOIN m{STEPS} USING (host)
"""


ORACLE_SQL = _oracle()
