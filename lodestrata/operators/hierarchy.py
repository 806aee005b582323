"""Parent-child links to full hierarchies (problem 6).

Weighted disjoint-set forests: every node points to an ancestor, with the number of steps to it and
the names on the way. Links that meet in one partition are combined there; the forests are then
merged by joins, in each of which every unfinished pointer takes on the pointer of its target. The
distance covered doubles, so the rounds grow with the logarithm of the depth. A round in which no
pointer reaches a root leaves only nodes on or below loops.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .skew import lookup_join

SEPARATOR = " > "
_POINTER = "tab string, node string, anc string, off long, way string"


def _local_forest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Contracts the chains inside one partition: way has the names from the ancestor to the node's parent."""
    frames = list(batches)
    if not frames:
        return
    links = pd.concat(frames, ignore_index=True)
    parent = dict(zip(zip(links["tab"], links["node"]), links["anc"]))
    found: dict[tuple[str, str], tuple[str, int, str]] = {}
    for start in parent:
        trail, on_trail, at = [], set(), start
        while at in parent and at not in found and at not in on_trail:
            trail.append(at)
            on_trail.add(at)
            at = (at[0], parent[at])
        looped = at in on_trail
        for node in reversed(trail):
            up = (node[0], parent[node])
            if looped or up not in found:
                found[node] = (parent[node], 1, parent[node])
            else:
                anc, off, way = found[up]
                found[node] = (anc, off + 1, way + SEPARATOR + parent[node])
    yield pd.DataFrame([(t, n, *x) for (t, n), x in found.items()], columns=["tab", "node", "anc", "off", "way"])


def lineages(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """tab, node, root, depth, path for each distinct (tab, node) of nodes.

    links has tab, node, parent with one parent per (tab, node) at most: of several, the first by
    name counts. A parent without a link of its own is a root, whether or not it is one of nodes. A
    node on or below a loop has root and path '' and depth -1. Rows with a null node or parent are
    left out; a node without a link is its own root. Names are of any length. Empty inputs give an
    empty result.
    """
    wanted = nodes.select("tab", "node").where("node is not null").distinct()
    single = links.where("node is not null and parent is not null").groupBy("tab", "node").agg(F.min("parent").alias("anc"))
    local = single.repartition("tab", "node").mapInPandas(_local_forest, _POINTER)
    pointers = cut_lineage(local.withColumn("done", F.lit(False)))
    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    left = pointers.count()
    while left:
        target = pointers.select("tab", F.col("node").alias("anc"), F.col("anc").alias("anc2"), F.col("off").alias("off2"), F.col("way").alias("way2"), F.col("done").alias("done2"))
        jumped = lookup_join(pointers.where(~F.col("done")), target, ["tab", "anc"])
        moved = jumped.select(
            "tab", "node", F.coalesce("anc2", "anc").alias("anc"), (F.col("off") + F.coalesce("off2", F.lit(0))).alias("off"),
            F.concat_ws(SEPARATOR, "way2", "way").alias("way"), F.coalesce("done2", F.lit(True)).alias("done"),
        )
        # Unions add up partitions; without coalesce their number would double with each round.
        pointers = cut_lineage(pointers.where("done").unionByName(moved).coalesce(parts))
        now = pointers.where(~F.col("done")).count()
        if now == left:
            break
        left = now
    ends = pointers.select("tab", "node", F.when(F.col("done"), F.col("anc")).otherwise("").alias("root"), F.when(F.col("done"), F.col("off")).otherwise(-1).alias("depth"),
                           F.when(F.col("done"), F.concat_ws(SEPARATOR, "way", "node")).otherwise("").alias("path"))
    return wanted.join(ends, ["tab", "node"], "left").select(
        "tab", "node", F.coalesce("root", "node").alias("root"), F.coalesce("depth", F.lit(0)).cast("int").alias("depth"), F.coalesce("path", "node").alias("path")
    )


def descendants(lineage: DataFrame) -> DataFrame:
    """tab, node, descendant, distance: each pair of a node and one below it, read off the paths; none on or below loops."""
    steps = lineage.where("depth > 0").select("tab", F.col("node").alias("descendant"), "depth", F.posexplode(F.split("path", SEPARATOR)).alias("at", "node"))
    return steps.where("at < depth").select("tab", "node", "descendant", (F.col("depth") - F.col("at")).alias("distance"))
