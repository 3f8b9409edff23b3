"""Connected components and root chasing by joins, for graphs that never fit one task."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auditlake.runtime import cut_lineage

#: Each round halves the longest chain that is left, so 40 rounds cover any graph that can be stored.
MAX_ROUNDS = 40


#: Links up to this many (tens of MB) are united by one task; more by rounds of joins.
SMALL_LINKS = 500_000


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", small_links: int = SMALL_LINKS) -> DataFrame:
    """(node, component) of every node on an edge; component is the smallest node of its component.

    Up to ``small_links`` distinct links one task unites them; the result is the same as that of the rounds.
    Alternates large-star and small-star rewirings (Kiveris et al., 2014): every step is one shuffle, hot nodes
    keep a running minimum instead of a collected neighbour list, and the number of rounds is logarithmic.
    Rows with a null end and loops are ignored; repeated edges count once; no edges give an empty result.
    """
    links = (
        edges.select(F.col(a).alias("u"), F.col(b).alias("v"))
        .where("u is not null and v is not null and u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()
    )
    links = cut_lineage(links)
    if links.count() <= small_links:
        return _united(links)
    mark = None
    for _ in range(MAX_ROUNDS):
        links = cut_lineage(_small_star(_large_star(links)))
        # a star forest is a fixed point; its sum of hashed links cannot change any more
        now = links.agg(F.count("*"), F.coalesce(F.sum(F.hash("u", "v").cast("decimal(38,0)")), F.lit(0))).first()
        if tuple(now) == mark:
            break
        mark = tuple(now)
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )


def _united(links: DataFrame) -> DataFrame:
    def unite(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        above: dict = {}

        def root(x: object) -> object:
            while above[x] != x:
                above[x] = x = above[above[x]]
            return x

        for part in batches:
            for u, v in zip(part["u"], part["v"]):
                above.setdefault(u, u)
                above.setdefault(v, v)
                x, y = sorted((root(u), root(v)))
                above[y] = x
        nodes = list(above)
        for k in range(0, len(nodes), 10_000):
            yield pd.DataFrame({"node": nodes[k : k + 10_000], "component": [root(x) for x in nodes[k : k + 10_000]]})

    kind = links.schema["u"].dataType.simpleString()
    return links.repartition(1).mapInPandas(unite, f"node {kind}, component {kind}")


def _both(links: DataFrame) -> DataFrame:
    return links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(links: DataFrame) -> DataFrame:
    both = _both(links)
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    linked = down.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return linked.union(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def chase_roots(parents: DataFrame, child: str, parent: str) -> DataFrame:
    """(child, root) with root the last id of each child's chain of parents, by pointer doubling.

    ``parents`` holds one row per child that has a parent. A chain that runs into a cycle has no root and is left
    out; a chain that ends at an id outside ``parents`` has that id as root. Depth d takes log2(d) joins.
    """
    step = cut_lineage(parents.select(F.col(child).alias("c"), F.col(parent).alias("p")).where("c is not null and p is not null"))
    rounds = step.count().bit_length() + 1  # after these, whatever still moves goes round a cycle
    for _ in range(rounds):
        up = step.select(F.col("c").alias("p"), F.col("p").alias("pp"))
        ahead = step.join(up, "p", "left").select("c", F.coalesce("pp", "p").alias("p"), F.col("pp").isNotNull().alias("moved"))
        ahead = cut_lineage(ahead)
        step = ahead.select("c", "p")
        if ahead.where("moved").isEmpty():
            break
    # only members of cycles (or chains into one) still point at a child
    return step.join(step.select(F.col("c").alias("p")), "p", "left_anti").select(F.col("c").alias(child), F.col("p").alias("root"))
