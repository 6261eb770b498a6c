"""URL filtering by rules, and by trust propagated over the host graph, in Spark expressions only.

Rules name a host (with its subdomains) and the beginning of a path; the longest fitting one
decides. Hosts whose pages the rules allow or block are seeds, weighted by the share of their
pages. Trust runs from allowed seeds along links (personalised PageRank), distrust from blocked
seeds against them, for a fixed number of rounds. Host edges are the absolute links of the pages,
and links both ways between a host and its nearest parent domain that has pages too.

Masses shrink with the degrees they pass, so each is measured against the mass that an even start from all
hosts brings to the same host by the same walk; a host's own even start counts only if rules judge any of its
pages. The distrust of a host is thus the share of blocked hosts in all that it leads to, near
hosts first: 1 for a host that links to blocked ones only, however many others do. A page that no
rule fits is blocked if its host's share of distrust exceeds its share of trust by more than `threshold`.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.shared import bounded_broadcast, settle_counted
from shelfwise.sources.scratch import settle

MOST_RULES = 1000
"""Rules become one expression; a longer list is refused."""
BROADCAST_ROWS = 2_000_000
DAMPING, ROUNDS, THRESHOLD = 0.85, 12, 0.5

_LINK = r"""(?i)href\s*=\s*["']?\s*(?:https?:)?//([^/?#"'\s>]+)"""


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (Rule("block", "net", "/"), Rule("allow", "example.net", "/en/"), Rule("block", "example.com", "/de/"), Rule("allow", "org", "/fr/"))


def ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def fitting(rules: tuple[Rule, ...], host: Column, path: Column, value) -> Column:
    """`value` of the longest rule that fits; null if none does. Equally long ones: the first by name."""
    if len(rules) > MOST_RULES:
        raise ValueError(f"at most {MOST_RULES} rules")
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (-len(r.name), r.name), reverse=True):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        found = F.when(fits, F.lit(value(rule))).otherwise(found)
    return found


def host_edges(pages: DataFrame, hosts: DataFrame) -> DataFrame:
    """Distinct (src, dst) between different hosts: links of the pages, and parent domains both ways."""
    links = pages.select(F.col("host").alias("src"), F.explode(F.regexp_extract_all("html", F.lit(_LINK), F.lit(1))).alias("dst"))
    links = links.select("src", ascii_lower(F.col("dst")).alias("dst")).where("src <> ''")
    labels = F.split("host", r"\.")
    above = F.expr("transform(sequence(2, greatest(2, size(labels))), i -> array_join(slice(labels, i, size(labels)), '.'))")
    names = hosts.select(F.col("host").alias("child"), labels.alias("labels")).select("child", F.posexplode(above).alias("far", "parent"))
    known = names.join(hosts.select(F.col("host").alias("parent")), "parent").groupBy("child").agg(F.min_by("parent", "far").alias("parent"))
    return (
        links.union(known.select("child", "parent")).union(known.select("parent", "child")).where("src <> dst and dst <> ''").distinct()
    )


def propagate(edges: DataFrame, seeds: DataFrame, damping: float = DAMPING, rounds: int = ROUNDS) -> DataFrame:
    """(host, trust, distrust, ahead, behind) after `rounds` steps, from `seeds` (host, trust, distrust).

    Trust moves along edges, distrust against them, each shared evenly among the next hosts;
    what a host without next hosts would pass on is lost. `ahead` and `behind` are the masses of an even start of 1
    at every host, along and against the edges. Both sides are one table, so a round is
    one join and one sum. Every third round is written, which bounds the lineage.
    """
    ways = edges.select(F.lit(1).alias("side"), "src", "dst").union(edges.select(F.lit(-1).alias("side"), F.col("dst").alias("src"), F.col("src").alias("dst")))
    degree = ways.groupBy("side", "src").agg(F.count(F.lit(1)).alias("degree"))
    steps = settle(ways.join(degree, ["side", "src"]).select("side", F.col("src").alias("host"), "dst", (F.lit(damping) / F.col("degree")).alias("share")), "steps")
    nodes = seeds.select("host", "trust", "distrust").union(edges.select(F.explode(F.array("src", "dst")).alias("host"), F.lit(0.0), F.lit(0.0)).distinct())
    both = F.array(*[F.struct(F.lit(side).alias("side"), F.col(name).alias("mass")) for side, name in ((1, "trust"), (-1, "distrust"))])
    start = nodes.groupBy("host").agg(F.max("trust").alias("trust"), F.max("distrust").alias("distrust")).select("host", F.explode(both).alias("s"))
    start = settle(start.select("s.side", "host", "s.mass", F.lit(1.0).alias("even")), "seeds")
    now = start
    if steps.isEmpty():
        rounds = 0
    for k in range(rounds):
        moved = now.join(steps, ["side", "host"]).select("side", F.col("dst").alias("host"), *[(F.col(name) * F.col("share")).alias(name) for name in ("mass", "even")])
        now = moved.union(start).groupBy("side", "host").agg(F.sum("mass").alias("mass"), F.sum("even").alias("even"))
        if k % 3 == 2:
            now = settle(now, "masses")
    masses = {alias: F.sum(F.when(F.col("side") == side, F.col(name)).otherwise(0.0)).alias(alias) for alias, side, name in (("trust", 1, "mass"), ("distrust", -1, "mass"), ("ahead", 1, "even"), ("behind", -1, "even"))}
    return now.groupBy("host").agg(*masses.values())


def _share(mass: str, even: str) -> Column:
    """Mass over the even mass without the host's own start, unless rules judge the host; 0 where nothing arrives."""
    base = F.col(even) - F.lit(1.0) + F.col("judged")
    return F.when(base > 1e-9, F.col(mass) / base).otherwise(0.0)


def bad_hosts(edges: DataFrame, hosts: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Hosts whose share of distrust exceeds their share of trust by more than `threshold`."""
    own = hosts.select("host", F.when(F.col("trust") + F.col("distrust") > 0, 1.0).otherwise(0.0).alias("judged"))
    reached = propagate(edges, hosts).join(own, "host", "left").na.fill(0.0, ["judged"])
    return reached.where(F.round(_share("distrust", "behind") - _share("trust", "ahead"), 9) > threshold).select("host")


def judge(pages: DataFrame, rules: tuple[Rule, ...] = RULES, threshold: float = THRESHOLD) -> DataFrame:
    """page_id, host, path, rule and verdict of every row of `pages`.

    A null url, or one without `://`, has an empty host and path, fits no rule and is allowed, as is
    any page whose host the propagation does not reach. A null html has no links. Repeated rows
    count as pages of their host and are judged each; other columns are ignored; an empty table
    gives an empty result.
    """
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    parsed = pages.select(F.col("page_id").cast("long").alias("page_id"), host.alias("host"), path.alias("path"), "html")
    verdict = fitting(rules, F.col("host"), F.col("path"), lambda r: r.verdict)
    share = lambda name: (F.count(F.when(verdict == name, 1)) / F.count(F.lit(1)))
    hosts = settle(parsed.where("host <> ''").groupBy("host").agg(share("allow").alias("trust"), share("block").alias("distrust")), "hosts")
    edges = settle(host_edges(parsed, hosts), "host-edges")
    bad, n_bad = settle_counted(bad_hosts(edges, hosts, threshold).withColumn("_host_verdict", F.lit("block")), "bad-hosts")
    rule = fitting(rules, F.col("host"), F.col("path"), lambda r: r.name)
    judged = parsed.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("_rule_verdict")).join(bounded_broadcast(bad, n_bad, BROADCAST_ROWS), "host", "left")
    return judged.select("page_id", "host", "path", "rule", F.coalesce("_rule_verdict", "_host_verdict", F.lit("allow")).alias("verdict"))


def _oracle() -> str:
    rounds = []
    for k in range(ROUNDS):
        rounds.append(f"""r{k + 1} AS MATERIALIZED (
  SELECT side, host, sum(mass) AS mass, sum(even) AS even FROM (
    SELECT s.side, s.dst AS host, r.mass * {DAMPING} / d.degree AS mass, r.even * {DAMPING} / d.degree AS even
    FROM r{k} r JOIN ways s ON s.side = r.side AND s.src = r.host JOIN degrees d ON d.side = s.side AND d.src = s.src
    UNION ALL SELECT * FROM r0) GROUP BY side, host)""")
    whens = {key: " ".join(f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') THEN '{value(r)}'" for r in sorted(RULES, key=lambda r: -len(r.name))) for key, value in (("rule", lambda r: r.name), ("verdict", lambda r: r.verdict))}
    return f"""
WITH parsed AS MATERIALIZED (
  SELECT page_id, coalesce(lower(regexp_extract(url, '://([^/?#]*)', 1)), '') AS host,
    coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path, html FROM pages),
ruled AS MATERIALIZED (
  SELECT *, CASE {whens["rule"]} END AS rule, CASE {whens["verdict"]} END AS rule_verdict FROM parsed),
hosts AS MATERIALIZED (
  SELECT host, count(*) FILTER (rule_verdict = 'allow') / count(*) AS trust,
    count(*) FILTER (rule_verdict = 'block') / count(*) AS distrust FROM ruled WHERE host <> '' GROUP BY host),
parents AS (
  SELECT c.host AS child, max_by(p.host, len(p.host)) AS parent FROM hosts c JOIN hosts p ON ends_with(c.host, '.' || p.host) GROUP BY c.host),
links AS (
  SELECT host AS src, lower(unnest(regexp_extract_all(html, 'href\\s*=\\s*["'']?\\s*(?:https?:)?//([^/?#"''\\s>]+)', 1, 'i'))) AS dst FROM parsed),
edges AS (
  SELECT DISTINCT src, dst FROM (SELECT * FROM links UNION ALL SELECT child, parent FROM parents UNION ALL SELECT parent, child FROM parents)
  WHERE src <> dst AND src <> '' AND dst <> ''),
ways AS MATERIALIZED (SELECT 1 AS side, src, dst FROM edges UNION ALL SELECT -1, dst, src FROM edges),
degrees AS MATERIALIZED (SELECT side, src, count(*) AS degree FROM ways GROUP BY side, src),
nodes AS (
  SELECT host, max(trust) AS trust, max(distrust) AS distrust FROM (
    SELECT host, trust, distrust FROM hosts UNION ALL SELECT src, 0, 0 FROM edges UNION ALL SELECT dst, 0, 0 FROM edges) GROUP BY host),
r0 AS MATERIALIZED (
  SELECT 1 AS side, host, CAST(trust AS double) AS mass, CAST(1 AS double) AS even FROM nodes
  UNION ALL SELECT -1, host, CAST(distrust AS double), CAST(1 AS double) FROM nodes),
{", ".join(rounds)},
shares AS (
  SELECT m.side, m.host, CASE WHEN m.even - 1 + j.judged > 1e-9 THEN m.mass / (m.even - 1 + j.judged) ELSE 0 END AS share
  FROM r{ROUNDS} m JOIN (SELECT host, CASE WHEN trust + distrust > 0 THEN 1 ELSE 0 END AS judged FROM nodes) j ON j.host = m.host),
bad AS (SELECT host FROM shares GROUP BY host HAVING round(sum(-side * share), 9) > {THRESHOLD})
SELECT page_id, host, path, rule, coalesce(rule_verdict, CASE WHEN host IN (SELECT host FROM bad) THEN 'block' ELSE 'allow' END) AS verdict FROM ruled
"""


ORACLE = _oracle()
