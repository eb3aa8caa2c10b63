"""Operator 6, URL filters: rules first, then trust and distrust propagated over the links between hosts.

Method (DataFrame functions only). Links of every page are resolved to hosts: absolute and
protocol-relative links name one, all others stay on the page's own host. Edges are host pairs with their
number of links. Trust starts at hosts with pages that a rule allows, distrust at hosts with pages that a
rule blocks, in proportion to these pages. Trust follows the links; distrust follows them backwards, to
hosts that link to distrusted ones. Both run in the same rounds of personalised PageRank: a round passes on
``damping`` per thousand of a host's mass in proportion to its links and returns the rest to the seeds, until
a round moves no more than ``TOLERANCE`` of all mass. Every round shrinks what is left to move by ``damping``, so
the rounds end by themselves, however far the links lead. A page without a rule is blocked if its host's
distrust is more than ``threshold`` times its trust and ``MARGIN`` of all mass.

Mass is counted in whole units of 10**-24 of all mass, as decimals of 38 digits; products come before the
division that rounds them down, so small shares are not lost and every engine and order of summation agrees.
Edges, not pages, take part in the rounds, and carry what leaves their source; they are aggregated on the map
side, so a hot host is one row a task. Ranks are written every few rounds, which cuts their lineage.

Defined results. Null url, or one without ``://``: empty host and path, no rule, judged by the method (the
empty host has no links and no mass: allowed). Null html: no links; html of any length is searched whole. Repeated
rows count as often as they stand there. No seeds at all: everything without a rule is allowed. An empty table
gives no rows, columns beside ``page_id``, ``url`` and ``html`` are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import Stored

#: (rule, verdict); the longest fitting rule wins. The rules that the query's contract fixes.
RULES = (("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block"))
UNIT = 10 ** 24
DAMPING = 850
THRESHOLD = 1
#: Shares of all mass: what a round may still move when the rounds end, and what distrust must exceed trust by.
TOLERANCE = UNIT // 10 ** 9
MARGIN = UNIT // 10 ** 7
#: Rounds between two looks at what they still move.
ROUNDS = 4
WIDE = "decimal(38,0)"
LINK = r"""(?i)<(?:a|area|link|iframe|form)\s[^>]*?(?:href|src|action)\s*=\s*["']([^"'>]*)["']"""
HOST = r"://([^/?#]*)"
PATH = r"://[^/?#]*([^?#]*)"
LINK_HOST = r"^\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)"


def _lower(c: Column) -> Column:
    """A-Z only; other letters stay."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split_url(url: Column) -> tuple[Column, Column]:
    u = F.coalesce(url, F.lit(""))
    return _lower(F.regexp_extract(u, HOST, 1)), F.regexp_extract(u, PATH, 1)


def _split_rule(rule: str) -> tuple[str, str]:
    host, _, path = rule.partition("/")
    return host, "/" + path


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits, as text, else null."""
    out = F.lit(None).cast("string")
    for rule, _ in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        rule_host, start = _split_rule(rule)
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(start)
        out = F.when(fits, F.lit(rule)).otherwise(out)
    return out


def host_edges(pages: DataFrame) -> DataFrame:
    """(src, dst, n): links between hosts; ``pages`` has host and html."""
    target = F.regexp_extract("link", LINK_HOST, 1)
    return (pages.where(F.col("host") != "").select("host", F.explode(F.regexp_extract_all("html", F.lit(LINK), 1)).alias("link"))
            .select(F.col("host").alias("src"), F.when(target != "", _lower(target)).otherwise(F.col("host")).alias("dst"))
            .groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n")))


def _units(n: int) -> Column:
    return F.lit(str(n)).cast(WIDE)


def _share(total: Column, part: Column, whole: Column) -> Column:
    """``total * part / whole`` in whole units, rounded down."""
    product, divisor = (total.cast(WIDE) * part.cast("decimal(20,0)")).cast(WIDE), whole.cast(WIDE)
    return ((product - F.pmod(product, divisor)) / divisor).cast(WIDE)


def both_ways(edges: DataFrame) -> DataFrame:
    """(kind, src, dst, n, out): edges as trust takes them and backwards for distrust, with all that leaves ``src``."""
    trust = edges.select(F.lit("trust").alias("kind"), "src", "dst", "n")
    distrust = edges.select(F.lit("distrust").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"), "n")
    ways = trust.unionByName(distrust)
    return ways.join(ways.groupBy("kind", "src").agg(F.sum("n").alias("out")), ["kind", "src"])


def propagate(edges: DataFrame, seeds: DataFrame, damping: int = DAMPING, tolerance: int = TOLERANCE, rounds: int = ROUNDS) -> DataFrame:
    """(kind, host, mass) when a round moves at most ``tolerance`` of each kind. ``seeds``: kind, host, seed."""
    none = F.lit(0).cast(WIDE)
    back = seeds.select("kind", "host", _share(F.col("seed"), F.lit(1000 - damping), F.lit(1000)).alias("mass"), none.alias("before"))
    ranks = seeds.select("kind", "host", F.col("seed").alias("mass"))
    while True:
        for _ in range(rounds):
            held = ranks.select("kind", F.col("host").alias("src"), "mass")
            moved = edges.join(held, ["kind", "src"]).select(
                "kind", F.col("dst").alias("host"), _share(F.col("mass"), F.col("n") * damping, F.col("out") * 1000).alias("mass"), none.alias("before"))
            old = ranks.select("kind", "host", none.alias("mass"), F.col("mass").alias("before"))
            ranks = moved.unionByName(back).unionByName(old).groupBy("kind", "host").agg(F.sum("mass").alias("mass"), F.sum("before").alias("before"))
        ranks = Stored(ranks, "host-ranks").df
        left = ranks.groupBy("kind").agg(F.sum(F.abs(F.col("mass") - F.col("before"))).alias("d")).agg(F.max("d")).first()[0]
        if (left or 0) <= tolerance:
            return ranks.select("kind", "host", "mass")


def filter_urls(pages: DataFrame, rules=RULES, damping: int = DAMPING, threshold: int = THRESHOLD) -> DataFrame:
    """(page_id, host, path, rule, verdict, trust, distrust) for every row of ``pages`` (page_id, url, html)."""
    host, path = split_url(F.col("url"))
    verdicts = F.create_map(*[F.lit(x) for rule in rules for x in rule]) if rules else F.create_map().cast("map<string,string>")
    p = pages.select("page_id", "html", host.alias("host"), path.alias("path"))
    p = p.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules)).withColumn("by_rule", F.when(F.col("rule").isNotNull(), verdicts[F.col("rule")]))
    edges = Stored(both_ways(host_edges(p)), "host-edges").df
    kind = F.when(F.col("by_rule") == "allow", "trust").when(F.col("by_rule") == "block", "distrust")
    counts = Stored(p.where("host <> ''").groupBy(kind.alias("kind"), "host").agg(F.count(F.lit(1)).alias("c")).where("kind IS NOT NULL"), "seed-counts").df
    all_pages = counts.groupBy("kind").agg(F.sum("c").alias("all"))  # at most two rows
    seeds = counts.join(F.broadcast(all_pages), "kind").select("kind", "host", _share(_units(UNIT), F.col("c"), F.col("all")).alias("seed"))
    ranks = propagate(edges, seeds, damping)
    mass = lambda kind: F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("mass"))), F.lit(0).cast(WIDE)).alias(kind)
    judged = ranks.groupBy("host").agg(mass("trust"), mass("distrust"))
    none = F.lit(0).cast(WIDE)
    trust, distrust = F.coalesce("trust", none), F.coalesce("distrust", none)
    blocked = distrust > trust * F.lit(threshold) + _units(MARGIN)
    out = p.drop("html").join(judged, "host", "left")
    verdict = F.coalesce("by_rule", F.when(blocked, F.lit("block")).otherwise(F.lit("allow")))
    return out.select("page_id", "host", "path", "rule", verdict.alias("verdict"), trust.alias("trust"), distrust.alias("distrust"))


def query(spark, sf_dir) -> DataFrame:
    from sluice.llm.common import table
    return filter_urls(table(spark, sf_dir, "pages")).drop("trust", "distrust")


#: Rounds of the SQL: what is left to move is then below the tolerance on any graph.
SQL_ROUNDS = 130


def _sql() -> str:
    fits = " ".join(
        f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{s}') THEN '{rule}'"
        for rule, _ in sorted(RULES, key=lambda r: -len(r[0])) for h, s in [_split_rule(rule)])
    verdicts = " ".join(f"WHEN '{rule}' THEN '{verdict}'" for rule, verdict in RULES)
    link, lower = LINK.replace("'", "''"), lambda c: f"translate({c}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
WITH RECURSIVE u AS MATERIALIZED (
  SELECT page_id, html, {lower(f"regexp_extract(coalesce(url, ''), '{HOST}', 1)")} AS host, regexp_extract(coalesce(url, ''), '{PATH}', 1) AS path FROM pages),
v AS MATERIALIZED (SELECT page_id, host, path, rule, CASE rule {verdicts} END AS by_rule FROM (SELECT *, CASE {fits} END AS rule FROM u)),
l AS (SELECT host, unnest(regexp_extract_all(html, '{link}', 1)) AS link FROM u WHERE host <> ''),
t AS (SELECT host, regexp_extract(link, '{LINK_HOST}', 1) AS target FROM l),
e AS MATERIALIZED (SELECT src, dst, count(*) AS n FROM (SELECT host AS src, CASE WHEN target <> '' THEN {lower('target')} ELSE host END AS dst FROM t) GROUP BY ALL),
ways AS MATERIALIZED (
  SELECT *, CAST(sum(n) OVER (PARTITION BY kind, src) AS HUGEINT) AS total
  FROM (SELECT 'trust' AS kind, src, dst, n FROM e UNION ALL SELECT 'distrust', dst, src, n FROM e)),
seeds AS MATERIALIZED (
  SELECT kind, host, CAST({UNIT} AS HUGEINT) * count(*) // CAST(sum(count(*)) OVER (PARTITION BY kind) AS HUGEINT) AS seed
  FROM (SELECT CASE by_rule WHEN 'allow' THEN 'trust' WHEN 'block' THEN 'distrust' END AS kind, host FROM v WHERE host <> '' AND by_rule IS NOT NULL)
  GROUP BY kind, host),
ranks AS (
  SELECT 0 AS step, kind, host, CAST(seed AS HUGEINT) AS mass FROM seeds
  UNION ALL
  SELECT step + 1, kind, host, CAST(sum(mass) AS HUGEINT) FROM (
    SELECT step, w.kind, w.dst AS host, mass * w.n * {DAMPING} // (w.total * 1000) AS mass FROM ranks r JOIN ways w ON w.kind = r.kind AND w.src = r.host
    UNION ALL
    SELECT step, s.kind, s.host, s.seed * {1000 - DAMPING} // 1000 FROM (SELECT DISTINCT step FROM ranks), seeds s)
  WHERE step < {SQL_ROUNDS} GROUP BY step, kind, host),
judged AS (
  SELECT host, coalesce(sum(mass) FILTER (kind = 'trust'), 0) AS trust, coalesce(sum(mass) FILTER (kind = 'distrust'), 0) AS distrust
  FROM ranks WHERE step = {SQL_ROUNDS} GROUP BY host)
SELECT page_id, v.host, path, rule,
       coalesce(by_rule, CASE WHEN coalesce(distrust, 0) > coalesce(trust, 0) * {THRESHOLD} + {MARGIN} THEN 'block' ELSE 'allow' END) AS verdict
FROM v LEFT JOIN judged ON v.host = judged.host"""


SQL = _sql()
