"""URL filters: rules by host and path, and, where no rule fits, what the graph of
links between hosts says (DataFrame functions only).

A rule fits its host and all subdomains if the path starts with the rule's; the
longest wins.  For the rest, trust and distrust spread over host edges, each
weighing as many as pages of the one host link to the other.  Trust is a
personalised PageRank from the hosts with allowed pages along the links; distrust
is the same from the hosts with blocked pages against the links, since a host
answers for what it links to.  A seed has the share of its host's pages that
rules allow or block, so scores are in units of one wholly allowed or blocked
host that nobody links.  A host whose distrust is over its trust by more than
``THRESHOLD`` is blocked; every other host is allowed.

How it runs: rules meet distinct hosts through the hosts' suffixes, no longer than
the longest rule's.  Only pages' links to other hosts are taken from their HTML.
In each round what a host got in the last one moves on by one join with the
edges; rounds end when nothing moves any more, or after ``ROUNDS``, when what is
left is under 0.85**50 of the seeds.  What each round moved is a written table.

Rows: a null url, or one without ``://``, has the host and path '' and no rule;
null HTML and links inside a host make no edge; repeated rows are judged one by
one; of rules equal in host and path a block wins; an empty table gives an empty
result.  Only ``page_id``, ``url`` and ``html`` are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratakit.llm.common import ascii_lower, staged

RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block"))
DAMPING = 0.85
ROUNDS = 50
#: Rounds end once no host gets more than this.
LEAST_MOVED = 1e-6
THRESHOLD = 0.5
#: The host of an absolute link of an ``a`` element.
LINK = r"""(?is)<a\s(?:[^<>]*?\s)?href\s*=\s*["']?\s*(?:https?:)?//([^/?#\s"'<>]*)"""


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3))
    return ascii_lower(F.coalesce(F.regexp_extract(rest, "^[^/?#]*", 0), F.lit(""))), F.coalesce(F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_table(spark: SparkSession, rules=RULES) -> DataFrame:
    return spark.createDataFrame(list(rules), "host string, path string, verdict string")


def fitting(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """``host, rules``: the rules for each host that has any, whatever the path."""
    labels = F.split("host", r"\.")
    most = rules.agg(F.max(F.size(labels))).first()[0] or 0
    n = F.least(F.size(labels), F.lit(most))
    suffix = F.transform(F.sequence(F.lit(1), n), lambda k: F.array_join(F.slice(labels, -k, k), "."))
    known = rules.select(
        F.col("host").alias("suffix"), F.struct(F.length(F.concat("host", "path")).alias("length"), "verdict", F.concat("host", "path").alias("rule"), "path").alias("found"))
    each = hosts.where(F.lit(most > 0)).select("host", F.explode(suffix).alias("suffix"))
    return each.join(known, "suffix").groupBy("host").agg(F.collect_list("found").alias("rules"))


def ruled(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """``page_id, host, path, rule, verdict``; the last two null where no rule fits."""
    host, path = host_and_path(F.col("url"))
    at = pages.select("page_id", host.alias("host"), path.alias("path"))
    joined = at.join(fitting(at.select("host").distinct(), rules), "host", "left")
    best = F.array_max(F.filter("rules", lambda r: F.startswith(F.col("path"), r["path"])))
    return joined.withColumn("best", best).select("page_id", "host", "path", F.col("best.rule").alias("rule"), F.col("best.verdict").alias("verdict"))


def host_edges(pages: DataFrame) -> DataFrame:
    """``source, target, pages``: how many pages of a host link to another host."""
    host, _ = host_and_path(F.col("url"))
    linked = F.array_distinct(F.transform(F.regexp_extract_all("html", F.lit(LINK), 1), ascii_lower))
    links = pages.where(F.col("html").contains("//")).select(host.alias("source"), F.explode(linked).alias("target"))
    return links.where((F.col("target") != "") & (F.col("source") != "") & (F.col("source") != F.col("target"))).groupBy("source", "target").agg(F.count(F.lit(1)).alias("pages"))


def steps(edges: DataFrame) -> DataFrame:
    """``kind, host, to, share``: the part of a host's trust that goes along each
    of its links, and of its distrust that goes back along each link to it."""
    out = edges.groupBy("source").agg(F.sum("pages").alias("all"))
    back = edges.groupBy("target").agg(F.sum("pages").alias("all"))
    share = F.col("pages") / F.col("all")
    trust = edges.join(out, "source").select(F.lit("trust").alias("kind"), F.col("source").alias("host"), F.col("target").alias("to"), share.alias("share"))
    distrust = edges.join(back, "target").select(F.lit("distrust").alias("kind"), F.col("target").alias("host"), F.col("source").alias("to"), share.alias("share"))
    return trust.unionByName(distrust)


def spread(seeds: DataFrame, moves: DataFrame, damping: float = DAMPING, rounds: int = ROUNDS) -> DataFrame:
    """``kind, host, score`` from ``kind, host, score`` of the seeds: what a host
    has itself and what comes to it over any number of steps."""
    moves = staged(moves)
    total = moved = staged(seeds)
    for _ in range(0 if moves.isEmpty() else rounds):
        moved = staged(moved.join(moves, ["kind", "host"]).groupBy("kind", F.col("to").alias("host")).agg((F.sum(F.col("score") * F.col("share")) * damping).alias("score")))
        total = total.unionByName(moved)
        if (moved.agg(F.max("score")).first()[0] or 0.0) < LEAST_MOVED:
            break
    return total.groupBy("kind", "host").agg(F.sum("score").alias("score"))


def host_scores(judged: DataFrame, edges: DataFrame) -> DataFrame:
    """``host, trust, distrust`` of every host that has any; ``judged``: see :func:`ruled`."""
    part = lambda v: (F.count_if(F.col("verdict") == v) / F.count(F.lit(1)))
    by_host = judged.where("host <> ''").groupBy("host").agg(part("allow").alias("trust"), part("block").alias("distrust"))
    seeds = by_host.unpivot("host", ["trust", "distrust"], "kind", "score").where("score > 0")
    found = spread(seeds.select("kind", "host", "score"), steps(staged(edges)))
    of = lambda k: F.sum(F.when(F.col("kind") == k, F.col("score")).otherwise(0.0)).alias(k)
    return found.groupBy("host").agg(of("trust"), of("distrust"))


def judge(pages: DataFrame, rules: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``page_id, host, path, rule, verdict`` of every page."""
    judged = staged(ruled(pages, rules))
    blocked = host_scores(judged, host_edges(pages)).where(F.col("distrust") - F.col("trust") > threshold).select("host", F.lit("block").alias("by_links"))
    return judged.join(blocked, "host", "left").select("page_id", "host", "path", "rule", F.coalesce("verdict", "by_links", F.lit("allow")).alias("verdict"))


def op13_link_graph_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages by the given rules and their own link graph."""
    return judge(spark.read.parquet(f"{sf_dir}/pages.parquet"), rule_table(spark))


#: The whole result in SQL.
SQL = r"""
with recursive rules(h, p, v) as (values ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
rest as (select row_number() over () i, page_id, html, case when instr(url, '://') > 0 then substring(url, instr(url, '://') + 3) end r from pages),
places as (select i, page_id, html, translate(coalesce(regexp_extract(r, '^[^/?#]*'), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') host, coalesce(regexp_extract(r, '^[^/?#]*([^?#]*)', 1), '') path from rest),
best as (select i, arg_max(h || p, length(h || p)) rule, arg_max(v, length(h || p)) v from places join rules on (host = h or ends_with(host, '.' || h)) and starts_with(path, p) group by i),
judged as (select places.*, rule, v from places left join best using (i)),
links as (select i, host, unnest(regexp_extract_all(html, '<a\s(?:[^<>]*?\s)?href\s*=\s*["'']?\s*(?:https?:)?//([^/?#\s"''<>]*)', 1, 'is')) t from judged),
edges as (select host s, translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') t, count(distinct i) n from links where t <> '' and host <> '' group by all having s <> t),
moves as (select 'trust' kind, s host, t "to", n / sum(n) over (partition by s) share from edges union all select 'distrust', t, s, n / sum(n) over (partition by t) from edges),
seeds as (select 'trust' kind, host, count(*) filter (v = 'allow') / count(*) score from judged where host <> '' group by host union all select 'distrust', host, count(*) filter (v = 'block') / count(*) from judged where host <> '' group by host),
moved as (select 0 k, kind, host, score from seeds where score > 0 union all
  select k + 1, kind, "to", sum(score * share) * 0.85 from moved join moves using (kind, host) where k < 50 group by k, kind, "to"),
scores as (select host, coalesce(sum(score) filter (kind = 'distrust'), 0) - coalesce(sum(score) filter (kind = 'trust'), 0) over_ from moved group by host)
select page_id, host, path, rule, coalesce(v, case when over_ > 0.5 then 'block' end, 'allow') verdict from judged left join scores using (host)"""
