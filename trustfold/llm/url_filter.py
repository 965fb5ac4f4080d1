"""URL filters: allow and block rules, and link-graph propagation where no rule speaks.

Rules (host, path) fit a host and all its subdomains if the url's path
begins with the rule's; the longest one wins.  Hosts are matched by an equi
join on their suffixes, so the number of rules does not matter and no url
meets every rule.

Hosts without a rule's word are judged by the graph of hosts:

* edges: links in the pages' html to other hosts (weight: number of pages
  that link), and a structural edge of weight ``parent_weight`` from every
  host to its parent domain and back (``m.x.example.org`` to
  ``x.example.org`` and so on up to two labels), since a page's relative
  links say nothing about other hosts;
* trust: personalised PageRank along the links, started from the hosts with
  allowed pages in proportion to the share of pages the rules allow;
* distrust: the same against the links, started from the hosts with blocked
  pages (whoever links to a blocked host is distrusted);
* a host is blocked when its distrust is at least ``ratio`` times its trust
  and at least ``floor`` times the mean over all hosts.

The ranks are ``rounds`` rounds of one join and one grouped sum over
distinct edges, both walks in one frame (column ``walk``), each round
checkpointed.  A host with a third of all pages is one row after the first
grouped count, which is made before any shuffle.  DataFrame functions only.

Cases: a null url or one without ``://`` has an empty host and path, fits no
rule and is allowed unless its (empty) host is blocked, which the graph never
does; null html has no links; empty hosts are no nodes; repeated rows count
as pages of their own; without any seed every unruled page is allowed; an
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trustfold.llm.tables import checkpointed, col, stored

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Absolute or protocol-relative link targets: the host part.
LINK = r"""(?i)\shref\s*=\s*["']?(?:https?:)?//([^"'\s>/?#]+)"""


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @classmethod
    def of(cls, verdict: str, text: str) -> Rule:
        """``com/`` or ``example.com/en/``: host up to the first slash, then the path."""
        host, slash, path = text.partition("/")
        return cls(verdict, host, slash + path)


def rules_table(spark: SparkSession, rules: Sequence[Rule]) -> DataFrame:
    """A small rule list as a table (rule_host, rule_path, rule_verdict); large lists come as such a table themselves."""
    rows = [F.struct(F.lit(r.host).alias("rule_host"), F.lit(r.path).alias("rule_path"), F.lit(r.verdict).alias("rule_verdict")) for r in rules]
    empty = spark.range(0).select(*(F.lit("").alias(c) for c in ("rule_host", "rule_path", "rule_verdict")))
    return spark.range(1).select(F.inline(F.array(*rows))) if rows else empty


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    # the path may be empty, or the match would go on to a later ://
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*((?:/[^?#]*)?)", 1), F.lit(""))


def suffixes(host: Column) -> Column:
    """The host and all its parent domains: ``a.b.c`` -> [a.b.c, b.c, c]."""
    labels = F.split(host, r"\.", -1)
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))


def ruled(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """Distinct (host, path) pairs that a rule fits, with the longest rule and its verdict."""
    pairs = urls.filter("host <> ''").select("host", "path").distinct()
    hosts = pairs.select("host").distinct().select("host", F.explode(suffixes(F.col("host"))).alias("rule_host"))
    candidates = hosts.join(rules, "rule_host")
    fits = pairs.join(candidates, "host").filter(F.expr("startswith(path, rule_path)"))
    best = F.max(F.struct(F.length(F.concat("rule_host", "rule_path")).alias("n"), "rule_host", "rule_path", "rule_verdict"))
    return (fits.groupBy("host", "path").agg(best.alias("b"))
            .select("host", "path", F.concat("b.rule_host", "b.rule_path").alias("rule"), F.col("b.rule_verdict").alias("rule_verdict")))


def host_edges(pages: DataFrame, parent_weight: float) -> DataFrame:
    """Distinct (src, dst, weight) between different hosts: links of pages (host, html), and domain structure."""
    linked = (pages.filter("host <> ''")
              .select("host", F.explode(F.array_distinct(F.transform(F.regexp_extract_all("html", F.lit(LINK), F.lit(1)),
                                                                       lambda h: F.translate(h, _UPPER, _LOWER)))).alias("dst"))
              .filter("host <> dst and dst <> ''").groupBy(F.col("host").alias("src"), "dst").agg(F.count(F.lit(1)).cast("double").alias("weight")))
    linked = stored(linked, "links")  # used three times; the html is read and matched once
    named = linked.select("src").union(linked.select("dst")).union(pages.filter("host <> ''").select("host")).distinct()
    chain = suffixes(F.col("src"))
    steps = (named.withColumn("chain", F.filter(chain, lambda h: F.instr(h, ".") > 0)).filter("size(chain) > 1")
             .select(F.explode(F.expr("transform(sequence(1, size(chain) - 1), i -> struct(chain[i - 1] as a, chain[i] as b))")).alias("e"))
             .select("e.a", "e.b").distinct())
    both = steps.select(F.col("a").alias("src"), F.col("b").alias("dst")).union(steps.select("b", "a"))
    return (linked.union(both.withColumn("weight", F.lit(float(parent_weight))))
            .groupBy("src", "dst").agg(F.sum("weight").alias("weight")))


#: Edges one task moves rank along in a round; a graph of fewer is one task's work.
EDGES_A_TASK = 250_000


def propagate(edges: DataFrame, seeds: DataFrame, *, rounds: int = 20, damping: float = 0.85) -> DataFrame:
    """Personalised PageRank of both walks: (walk, host, rank); seeds are (walk, host, weight), summing to 1 a walk.

    ``trust`` follows the edges, ``distrust`` goes against them.  A round is
    ``(1 - damping) * seeds + damping * moved``; at the end each walk is
    scaled to 1, which is where sending the rank of hosts without an edge
    back to the seeds ends, too.  Each round is one join and one grouped sum,
    checkpointed, so the plan stays small however many rounds there are.  A
    round is as many tasks as its edges fill (at most the session's shuffle
    partitions), so a small graph does not write a file per partition and round.
    """
    steps = (edges.select(F.lit("trust").alias("walk"), "src", "dst", "weight")
             .union(edges.select(F.lit("distrust"), "dst", "src", "weight")))
    out = steps.groupBy("walk", "src").agg(F.sum("weight").alias("out"))
    tasks = 1 + 2 * edges.count() // EDGES_A_TASK
    steps = checkpointed(steps.join(out, ["walk", "src"]).select("walk", F.col("src").alias("host"), "dst", (F.col("weight") / F.col("out")).alias("share")).coalesce(tasks))
    home = checkpointed(seeds.select("walk", "host", (F.col("weight") * (1 - damping)).alias("rank")).coalesce(tasks))
    rank = home
    for _ in range(rounds):
        moved = rank.join(steps, ["walk", "host"]).select("walk", F.col("dst").alias("host"), (damping * F.col("rank") * F.col("share")).alias("rank"))
        rank = checkpointed(moved.union(home).groupBy("walk", "host").agg(F.sum("rank").alias("rank")).coalesce(tasks))
    total = rank.groupBy("walk").agg(F.sum("rank").alias("total"))  # a row a walk
    return rank.join(total, "walk").select("walk", "host", (F.col("rank") / F.col("total")).alias("rank"))


def judge(pages: DataFrame, rules: DataFrame, *, id_column: str = "page_id", url_column: str = "url", html_column: str = "html",
          rounds: int = 20, damping: float = 0.85, parent_weight: float = 0.5, ratio: float = 1.0, floor: float = 0.25) -> DataFrame:
    """Return per row: id, host, path, rule, verdict, trust, distrust (ranks of the host, 0 if it has none)."""
    url = col(url_column).cast("string")
    rows = pages.select(col(id_column).alias("id"), host_of(url).alias("host"), path_of(url).alias("path"))
    urls = stored(rows, "urls")
    found = stored(ruled(urls, rules), "ruled")
    counted = urls.filter("host <> ''").groupBy("host", "path").agg(F.count(F.lit(1)).alias("n")).join(found, ["host", "path"], "left")
    per_host = checkpointed(counted.groupBy("host").agg(F.sum("n").alias("n"), *(
        F.sum(F.when(F.col("rule_verdict") == v, F.col("n")).otherwise(0)).alias(v) for v in ("allow", "block"))))
    seeds = per_host.select("host", F.expr("stack(2, 'trust', allow / n, 'distrust', block / n) as (walk, weight)")).filter("weight > 0")
    sums = seeds.groupBy("walk").agg(F.sum("weight").alias("total"))
    seeds = seeds.join(sums, "walk").select("walk", "host", (F.col("weight") / F.col("total")).alias("weight"))
    edges = checkpointed(host_edges(pages.select(host_of(url).alias("host"), col(html_column).cast("string").alias("html")), parent_weight))
    rank = propagate(edges, seeds, rounds=rounds, damping=damping)
    ranks = (rank.groupBy("host").agg(*(F.sum(F.when(F.col("walk") == w, F.col("rank")).otherwise(0.0)).alias(w) for w in ("trust", "distrust"))))
    hosts = rank.select("host").distinct().count()
    bad = checkpointed(ranks.select("host", "trust", "distrust", (
        (F.col("distrust") >= ratio * F.col("trust")) & (F.col("distrust") * hosts >= floor)).alias("blocked")))
    return (urls.join(found, ["host", "path"], "left").join(bad, "host", "left")
            .select(F.col("id").alias(id_column), "host", "path", "rule",
                    F.coalesce("rule_verdict", F.when(F.col("blocked"), "block").otherwise("allow")).alias("verdict"),
                    F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust")))
