"""URL filter: rules for known hosts, propagation over the host graph for all others.

Pages that an allow rule fits make their host a trusted seed, pages that a block rule fits a blocked one,
each by its number of pages. Trust flows from trusted seeds along the edges (personalised PageRank),
distrust from blocked seeds against them (who leads to blocked hosts is suspect). Edges are hyperlinks
between hosts, and both ways between a host and its parent domain. A page without a rule is
blocked when its host's distrust exceeds its trust. Rounds go on until the mass has settled (TOLERANCE) and
no host is reached for the first time, however far it is from the seeds.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, cut, discard, store, table

DAMPING = 0.85
#: Summed change of the mass of either kind in a last round.
TOLERANCE = 1e-6
#: Rounds after which the change is below TOLERANCE on any graph: it is at most 2 * DAMPING ** n in round n.
ROUNDS = math.ceil(math.log(TOLERANCE / 2) / math.log(DAMPING))
#: Rounds between two cuts of the lineage.
CUT_EVERY = 4
#: A host is blocked when distrust > RATIO * trust.
RATIO = 1.0
SPLIT_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path

    def fits(self, host: Column, path: Column) -> Column:
        return ((host == self.host) | host.endswith("." + self.host)) & path.startswith(self.path)


# Fixed values.
RULES = (
    Rule("net", "/", "block"),
    Rule("example.net", "/en/", "allow"),
    Rule("example.com", "/de/", "block"),
    Rule("org", "/fr/", "allow"),
)


def host_of(url: Column) -> Column:
    return ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), SPLIT_URL, 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), SPLIT_URL, 2)


def longest(rules, host: Column, path: Column, give) -> Column:
    """give(rule) of the longest rule that fits, or null."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.name)):
        out = F.when(rule.fits(host, path), F.lit(give(rule))).otherwise(out)
    return out


def edges(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Distinct host edges (`src`, `dst`): hyperlinks to other hosts, and host and parent domain both ways."""
    html = F.coalesce(F.col(html_col), F.lit(""))
    found = F.regexp_extract_all(html, F.lit(r"""(?i)\bhref\s*=\s*["']?\s*((?:https?:)?//[^"'\s>]+)"""), F.lit(1))
    links = pages.select(host_of(F.col(url_col)).alias("src"), F.explode(F.array_distinct(found)).alias("to"))
    absolute = F.when(F.col("to").startswith("//"), F.concat(F.lit("http:"), "to")).otherwise(F.col("to"))
    links = links.select("src", host_of(absolute).alias("dst")).filter("src != '' AND dst != '' AND src != dst").distinct()
    hosts = pages.select(host_of(F.col(url_col)).alias("h")).filter("h != ''").distinct()
    hosts = hosts.union(links.select("dst")).distinct()
    labels = F.split("h", r"\.")
    # All suffixes of two labels and more, from the host up; neighbours are joined both ways.
    up = F.transform(F.sequence(F.lit(1), F.greatest(F.size(labels) - 1, F.lit(1))), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    chain = hosts.filter(F.size(labels) > 2).select(up.alias("up"))
    steps = F.transform(F.sequence(F.lit(0), F.size("up") - 2), lambda i: F.struct(F.get("up", i).alias("src"), F.get("up", i + 1).alias("dst")))
    tree = chain.select(F.explode(steps).alias("e")).select("e.src", "e.dst").distinct()
    return links.union(tree).union(tree.select("dst", "src")).distinct()


def propagate(links: DataFrame, seeds: DataFrame, rounds: int = ROUNDS, damping: float = DAMPING) -> DataFrame:
    """(`host`, `trust`, `distrust`) of all hosts that mass reaches.

    seeds: `host`, `trusted`, `blocked` (weights, each scaled to sum 1). A host without way out keeps its mass.
    rounds is the least number; more follow while they reach new hosts.
    Hosts with very many edges are summed before each shuffle; the join on the source of an
    edge is a plain equi-join whose large sides Spark splits.
    """
    spark = links.sparkSession
    both = links.select(F.lit("trust").alias("kind"), "src", "dst").union(links.select(F.lit("distrust"), "dst", "src"))
    start = seeds.select(
        "host", F.explode(F.create_map(F.lit("trust"), "trusted", F.lit("distrust"), "blocked")).alias("kind", "mass")
    ).filter("mass > 0")
    total = start.groupBy("kind").agg(F.sum("mass").alias("total"))
    start = cut(start.join(total, "kind").select("kind", "host", (F.col("mass") / F.col("total")).alias("seed")), "seeds")
    ends = both.select("kind", F.col("dst").alias("src")).union(start.select("kind", "host")).distinct()
    loops = ends.join(both.select("kind", "src").distinct(), ["kind", "src"], "left_anti").select("kind", "src", F.col("src").alias("dst"))
    both = both.union(loops)
    degree = both.groupBy("kind", "src").agg(F.count(F.lit(1)).alias("degree"))
    graph = cut(both.join(degree, ["kind", "src"]).select("kind", F.col("src").alias("host"), "dst", (damping / F.col("degree")).alias("w")), "graph")
    restart = start.select("kind", "host", (F.col("seed") * (1 - damping)).alias("mass"))
    rank, last = start.select("kind", "host", F.col("seed").alias("mass")), None
    reached, i = None, 0
    while True:
        i += 1
        moved = rank.join(graph, ["kind", "host"]).select("kind", F.col("dst").alias("host"), (F.col("mass") * F.col("w")).alias("mass"))
        rank = moved.union(restart).groupBy("kind", "host").agg(F.sum("mass").alias("mass"))
        if i % CUT_EVERY == 0 or i == rounds:
            rank, path = store(rank, "rank")
            if last:
                discard(spark, last)
            last = path
            # Seeds give mass in every round, so a host that has some keeps some: equal counts mean no new host.
            before, reached = reached, rank.count()
            if reached == 0 or i >= rounds and reached == before:
                break
    part = lambda kind: F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("mass"))), F.lit(0.0)).alias(kind)
    return rank.groupBy("host").agg(part("trust"), part("distrust"))


def judge(pages: DataFrame, rules=RULES, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: `id`, `host`, `path`, `rule`, `verdict`, `trust`, `distrust`.

    Null urls and urls without :// have an empty host and path, fit no rule and are allowed, as is any
    host that neither trust nor distrust reaches. Null html has no links. Repeated pages count as
    often as they occur in the seeds and once in the edges. No rows: no rows.
    """
    host, path = F.col("host"), F.col("path")
    urls = pages.select(F.col(id_col).alias("id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    ruled = urls.withColumns(
        {"rule": longest(rules, host, path, lambda r: r.name), "ruled": longest(rules, host, path, lambda r: r.verdict)}
    )
    count = lambda verdict: F.sum((F.col("ruled") == verdict).cast("long"))
    seeds = ruled.filter("ruled IS NOT NULL").groupBy("host").agg(count("allow").alias("trusted"), count("block").alias("blocked"))
    scores = propagate(edges(pages, url_col, html_col), seeds)
    # Scores are one row per host; Spark broadcasts them only if they are small.
    joined = ruled.join(scores, "host", "left")
    trust, distrust = (F.coalesce(c, F.lit(0.0)) for c in ("trust", "distrust"))
    own = F.when(distrust > RATIO * trust, "block").otherwise("allow")
    return joined.select(
        "id", "host", "path", "rule", F.coalesce("ruled", own).alias("verdict"), trust.alias("trust"), distrust.alias("distrust")
    )


def op2_url_filter(spark, sf_dir) -> DataFrame:
    rows = judge(table(spark, sf_dir, "pages"))
    return rows.select(F.col("id").alias("page_id"), "host", "path", "rule", "verdict", "trust", "distrust")
