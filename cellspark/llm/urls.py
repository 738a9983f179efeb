"""URL filters: rules on hosts and paths, and link-graph propagation for urls that no rule fits.

Hosts are the nodes of the graph. Edges are the links of the pages that lead to another host, and, as hosts
of one owner, each host and its parent domain where both occur, or, with ``domains``, each host and its parents up to
the registered domain, whether or not those have pages, so that their other hosts are reached too. Seeds come from the rules: a host is
trusted, or blocked, by the share of its pages that a rule allows, or blocks; hosts may also be named.
Trust spreads along edges as a personalised PageRank, distrust against them; as seeds are not normalised,
scores do not depend on the number of hosts. A host is blocked if its distrust reaches the threshold and
exceeds its trust. Only hosts and edges between hosts are joined in the iterations; pages meet the scores once. The edges of a host with
more than ``HUB_EDGES`` are dealt to several keys, to each of which its score is sent. Connected components of at most
``WHOLE_EDGES`` edges go through the same rounds inside one task each, many components together; rounds over tables
are for larger ones.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellspark.functions.lineage import store
from cellspark.llm.components import connected_components

#: (verdict, host, path)
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
DAMPING = 0.85
#: ``propagate`` goes on until what is left is below ``PRECISION``, far below the nine digits of the scores.
PRECISION, MOST_ROUNDS, STORE_EVERY = 1e-11, 1000, 4
HUB_EDGES = 100_000
WHOLE_EDGES, BLOCK_EDGES = 200_000, 1_000_000
THRESHOLD = 0.01
#: Suffixes of two labels under which domains of different owners are registered.
SUFFIXES = (
    "ac.uk", "co.uk", "gov.uk", "org.uk", "com.au", "net.au", "org.au", "co.nz", "co.za", "co.in", "co.jp", "ne.jp", "or.jp", "co.kr",
    "com.br", "com.cn", "com.mx", "com.tr", "com.tw",
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """What lies between the first ``://`` and ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def ruled(host: Column, path: Column, rules: Iterable[tuple[str, str, str]]) -> Column:
    """The longest fitting rule as a struct (verdict, rule), or null. Of equally long ones the first given wins."""
    fits = [
        F.when(
            ((host == h) | host.endswith("." + h)) & path.startswith(p),
            F.struct(F.lit(verdict).alias("verdict"), F.lit(h + p).alias("rule")),
        )
        for verdict, h, p in sorted(rules, key=lambda r: -len(r[1] + r[2]))
    ]
    return F.coalesce(*fits, F.lit(None).cast("struct<verdict:string,rule:string>"))


def domain_edges(hosts: DataFrame, suffixes: Iterable[str] = ()) -> DataFrame:
    """(host, parent) of hosts and their parents up to two labels, each once; addresses and ``suffixes`` (co.uk, say) have none above them."""
    labels = F.split("host", r"\.")
    names = F.transform(F.sequence(F.lit(1), F.size(labels) - 1), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    chains = hosts.where((F.size(labels) > 2) & ~F.col("host").rlike(r"^[0-9.]+(:[0-9]*)?$")).select(F.filter(names, lambda n: ~n.isin([*suffixes]) if suffixes else F.lit(True)).alias("names"))
    steps = F.arrays_zip(F.slice("names", 1, F.size("names") - 1).alias("host"), F.slice("names", 2, F.size("names") - 1).alias("parent"))
    return chains.where(F.size("names") > 1).select(F.inline(steps)).distinct()


def host_edges(pages: DataFrame, html: str, parents: bool, domains: bool = False, suffixes: Iterable[str] = ()) -> DataFrame:
    """(src, dst, n) between different hosts of ``pages`` (host, html)."""
    target = F.regexp_extract_all(F.coalesce(F.col(html), F.lit("")), F.lit(r"""(?i)<a\s[^>]*?href\s*=\s*["']?\s*((?:https?:)?//[^"'\s>]+)"""), F.lit(1))
    found = pages.select(F.col("host").alias("src"), F.explode(F.array_distinct(F.transform(target, lambda u: host_of(F.concat(F.lit("x:"), F.regexp_replace(u, "^(?i:https?:)", "")))))).alias("dst"))
    edges = found.where((F.col("src") != F.col("dst")) & (F.col("src") != "") & (F.col("dst") != "")).groupBy("src", "dst").agg(F.count("*").alias("n"))
    if parents or domains:
        hosts = pages.select("host").where("host != ''").distinct()
        above = hosts.select("host", F.regexp_extract("host", r"^[^.]+\.(.+)$", 1).alias("parent"))
        pairs = domain_edges(hosts, tuple(suffixes)) if domains else above.join(hosts.select(F.col("host").alias("parent")), "parent")
        both = pairs.select(F.col("host").alias("src"), F.col("parent").alias("dst")).union(pairs.select("parent", "host"))
        edges = edges.union(both.withColumn("n", F.lit(1).cast("bigint"))).groupBy("src", "dst").agg(F.sum("n").alias("n"))
    return edges


def solve_whole(block: pa.Table, damping: float, most: int) -> pa.Table:
    """(kind, host, score, left) of a block's components, from edges (kind, host, to, share) and own shares (to is null); left is what later rounds may add."""
    frame = block.to_pandas()
    sides = [list(zip(frame["kind"], frame[side], strict=True)) for side in ("host", "to")]
    number: dict[tuple[int, str], int] = {}
    source, target = (np.array([number.setdefault(node, len(number)) for node in side], np.int64) for side in sides)
    names = list(number)
    edge = frame["to"].notna().to_numpy()
    value = frame["share"].to_numpy(np.float64)
    own = np.bincount(source[~edge], value[~edge], len(names))
    source, target, share = source[edge], target[edge], value[edge]
    score, fresh, done = own, own, 0
    while (left := fresh.sum() * damping / (1 - damping)) > PRECISION and done < most:
        fresh, done = np.bincount(target, fresh[source] * share, len(names)), done + 1
        score = score + fresh
    found = [(kind, host, x) for (kind, host), x in zip(names, score.tolist(), strict=True) if host is not None]
    kinds, hosts, scores = zip(*found, strict=True)
    return pa.table({"kind": pa.array(kinds, pa.int32()), "host": pa.array(hosts, pa.string()), "score": pa.array(scores, pa.float64()), "left": pa.array([left] * len(found), pa.float64())})


def propagate(seeds: DataFrame, edges: DataFrame, damping: float = DAMPING, most: int = MOST_ROUNDS, hub: int = HUB_EDGES, whole: int = WHOLE_EDGES) -> DataFrame:
    """(host, trust, distrust) of hosts with any score, from seeds (host, trust, distrust) and edges (src, dst, n).

    Trust is shared among a host's outgoing edges, distrust among its incoming ones, by their weights; what
    reaches a host without a way on ends there. What a round adds in all (``fresh``) is at most ``damping`` times
    what the round before added, so all later rounds together add at most fresh * damping / (1 - damping) to all
    scores; rounds end when that is below ``PRECISION``. ``most`` rounds without that raise an error. ``parts`` is
    the number of keys that a host's edges are dealt to, at most ``hub`` or so to each; null without edges.
    Components of at most ``whole`` edges are solved in blocks of them, each in a task of its own.
    """
    both = edges.select(F.inline(F.array(
        F.struct(F.lit(0).alias("kind"), F.col("src").alias("host"), F.col("dst").alias("to"), "n"), F.struct(F.lit(1).alias("kind"), F.col("dst").alias("host"), F.col("src").alias("to"), "n")
    )))
    nodes = store(both.groupBy("kind", "host").agg(F.sum("n").alias("all"), F.ceil(F.count("*") / hub).alias("parts")))
    onward = nodes.select("kind", F.col("host").alias("to"), F.col("parts").alias("to_parts"))
    all_ways = (
        both.join(nodes, ["kind", "host"]).join(onward, ["kind", "to"], "left")
        .select("kind", "host", F.pmod(F.xxhash64("to"), "parts").alias("part"), "to", "to_parts", (F.col("n") / F.col("all") * damping).alias("share"))
    )
    # two hosts of one hash are in one component then, which changes no score
    within = connected_components(edges.select(F.xxhash64("src").alias("src"), F.xxhash64("dst").alias("dst")))
    parted = all_ways.withColumn("id", F.xxhash64("host")).join(within, "id").drop("id")
    sizes = parted.groupBy("component").agg(F.count("*").alias("edges"))
    grouped = store(parted.join(sizes, "component"))
    small = F.col("edges") <= whole
    start = seeds.select("host", F.inline(F.array(F.struct(F.lit(0).alias("kind"), F.col("trust").alias("score")), F.struct(F.lit(1).alias("kind"), F.col("distrust").alias("score"))))).where("score > 0")
    start = start.join(nodes, ["kind", "host"], "left").select("kind", "host", "parts", (F.col("score") * (1 - damping)).alias("score"))
    groups = grouped.select("component", "edges").distinct()
    start = store(start.withColumn("id", F.xxhash64("host")).join(within, "id", "left").drop("id").join(groups, "component", "left"))
    total = grouped.where(small).count()
    blocks = max(1, -(-total // BLOCK_EDGES))
    block = F.pmod(F.xxhash64("component"), F.lit(blocks)).alias("block")
    rows = grouped.where(small).select(block, "kind", "host", "to", "share").union(start.where(small).select(block, "kind", "host", F.lit(None).cast("string"), "score"))
    solved = store(rows.groupBy("block").applyInArrow(lambda t: solve_whole(t, damping, most), "kind int, host string, score double, left double"))
    left = solved.agg(F.max("left")).first()[0] or 0.0
    if left > PRECISION:
        raise RuntimeError(f"host scores still change by up to {left} after {most} rounds")
    solved = solved.drop("left").union(start.where("edges is null").select("kind", "host", "score"))
    ways, own = grouped.where(~small), start.where(~small).select("kind", "host", "parts", "score")
    now, done, left = own.withColumn("fresh", F.col("score")), 0, not ways.isEmpty()
    while left:
        if done >= most:
            raise RuntimeError(f"host scores still change by up to {left} after {done} rounds")
        for _ in range(STORE_EVERY):
            sent = now.where("parts > 0").select("kind", "host", "score", "fresh", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)).alias("part"))
            moved = sent.join(ways.select("kind", "host", "part", "to", "to_parts", "share"), ["kind", "host", "part"]).select("kind", F.col("to").alias("host"), F.col("to_parts").alias("parts"), (F.col("score") * F.col("share")).alias("score"), (F.col("fresh") * F.col("share")).alias("fresh"))
            now = own.withColumn("fresh", F.lit(0.0)).unionByName(moved).groupBy("kind", "host").agg(F.max("parts").alias("parts"), F.sum("score").alias("score"), F.sum("fresh").alias("fresh"))
        now, done = store(now), done + STORE_EVERY
        fresh = now.agg(F.sum("fresh")).first()[0] or 0.0
        left = fresh * damping / (1 - damping) if fresh * damping > PRECISION * (1 - damping) else 0
    now = now.select("kind", "host", "score").union(solved)
    return now.groupBy("host").agg(F.sum(F.when(F.col("kind") == 0, F.col("score")).otherwise(0.0)).alias("trust"), F.sum(F.when(F.col("kind") == 1, F.col("score")).otherwise(0.0)).alias("distrust"))


def judge(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", rules: Iterable[tuple[str, str, str]] = RULES,
          trusted: Iterable[str] = (), blocked: Iterable[str] = (), parents: bool = True, threshold: float = THRESHOLD,
          damping: float = DAMPING, most: int = MOST_ROUNDS, domains: bool = False, suffixes: Iterable[str] = SUFFIXES, hub: int = HUB_EDGES) -> DataFrame:
    """(key, host, path, rule, verdict, trust, distrust) of every row of ``pages``.

    A rule decides where one fits; else the host's scores do. Urls that are null or lack ``://`` have an empty
    host and path, fit no rule, have no scores and are allowed, as are hosts that nothing reaches. Null html
    has no links. Scores are rounded to nine digits. Repeated rows count each, no rows give none.
    """
    rules = tuple(rules)
    at = pages.select(F.col(key).alias("key"), F.col(url).cast("string").alias("url"), F.col(html).cast("string").alias("html"))
    at = at.select("key", "html", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    at = at.withColumn("found", ruled(F.col("host"), F.col("path"), rules))
    share = {v: F.avg(F.when(F.col("found.verdict") == v, 1.0).otherwise(0.0)) for v in ("allow", "block")}
    seeds = at.where("host != ''").groupBy("host").agg(share["allow"].alias("trust"), share["block"].alias("distrust"))
    for name, hosts in (("trust", [*trusted]), ("distrust", [*blocked])):
        seeds = seeds.withColumn(name, F.when(F.col("host").isin(hosts), 1.0).otherwise(F.col(name)) if hosts else F.col(name))
    scores = propagate(seeds, host_edges(at, "html", parents, domains, suffixes), damping, most, hub)
    trust, distrust = F.round(F.coalesce("trust", F.lit(0.0)), 9), F.round(F.coalesce("distrust", F.lit(0.0)), 9)
    return (
        at.drop("html")
        .join(scores, "host", "left")
        .select("key", "host", "path", "found", trust.alias("trust"), distrust.alias("distrust"))
        .select(
            F.col("key").alias(key), "host", "path", F.col("found.rule").alias("rule"),
            F.coalesce("found.verdict", F.when((F.col("distrust") >= threshold) & (F.col("distrust") > F.col("trust")), "block").otherwise("allow")).alias("verdict"),
            "trust", "distrust",
        )
    )
