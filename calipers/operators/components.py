"""Connected components of a graph given as tables, for many graphs (images) at once.

Randomised contraction: in every round each node is merged into the least node of
its closed neighbourhood, under an order drawn anew from a hash. The number of
edges falls geometrically in expectation, whatever the shape (a plain least-label
flood needs as many rounds as the longest path). Then the rounds are composed
backwards. Every step is a grouped minimum or an equi-join, so a giant component
is spread over tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from calipers.runtime import checkpointed, release, settle


def _representatives(edges: DataFrame, group: str, seed: int) -> DataFrame:
    """(group, node, rep) for every node that still has an edge."""
    order = lambda c: F.struct(F.xxhash64(F.lit(seed), F.col(group), c).alias("h"), c.alias("n"))
    directed = edges.select(group, F.inline(F.array(
        F.struct(F.col("a").alias("node"), F.col("b").alias("other")),
        F.struct(F.col("b").alias("node"), F.col("a").alias("other")),
    )))
    nearest = directed.groupBy(group, "node").agg(F.min(order(F.col("other"))).alias("o"))
    return nearest.select(group, "node", F.least(F.col("o"), order(F.col("node"))).getField("n").alias("rep"))


def _contract(edges: DataFrame, reps: DataFrame, group: str) -> DataFrame:
    ra = reps.select(group, F.col("node").alias("a"), F.col("rep").alias("ra"))
    rb = reps.select(group, F.col("node").alias("b"), F.col("rep").alias("rb"))
    return (
        edges.join(ra, on=[group, "a"])
        .join(rb, on=[group, "b"])
        .where("ra <> rb")
        .select(group, F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b"))
        .distinct()
    )


def component_labels(edges: DataFrame, group: str) -> DataFrame | None:
    """(group, node, label) for the nodes of `edges`, label being the least node of the component.

    `edges`: group, a, b in any direction, between nodes of one group. None without edges.
    """
    edges = checkpointed(edges.where("a <> b").select(group, "a", "b"))
    rounds: list[DataFrame] = []
    while not edges.isEmpty():
        reps = checkpointed(_representatives(edges, group, len(rounds)))
        rounds.append(reps)
        edges = checkpointed(_contract(edges, reps, group))
    if not rounds:
        return None
    roots = rounds.pop().withColumnRenamed("rep", "root")
    while rounds:
        later = roots.select(group, F.col("node").alias("rep"), F.col("root").alias("later"))
        roots = rounds.pop().join(later, on=[group, "rep"], how="left").select(
            group, "node", F.coalesce("later", "rep").alias("root")
        )
    roots = checkpointed(roots)
    least = roots.groupBy(group, "root").agg(F.min("node").alias("label"))
    return roots.join(least, on=[group, "root"]).select(group, "node", "label")


def connected_components(nodes: DataFrame, edges: DataFrame, group: str) -> DataFrame:
    """The same for all `nodes` (group, node); nodes without edges are their own component."""
    found = component_labels(edges, group)
    if found is None:
        return nodes.select(group, "node", F.col("node").alias("label"))
    return nodes.join(found, on=[group, "node"], how="left").select(
        group, "node", F.coalesce("label", "node").alias("label")
    )


def pointer_roots(parents: DataFrame, group: str) -> DataFrame:
    """(group, node, root) by pointer jumping; `parents`: group, node, parent (parent = node at a root).

    Each round doubles the distance, so the rounds grow with the logarithm of the longest chain.
    """
    held = hops = settle(parents.select(group, "node", "parent"))
    while True:
        nxt = hops.select(group, F.col("node").alias("parent"), F.col("parent").alias("grand"))
        jumped = hops.join(nxt.hint("merge"), on=[group, "parent"]).select(
            group, "node", F.col("grand").alias("parent"), (F.col("grand") != F.col("parent")).alias("moved")
        )
        jumped = settle(jumped)
        release(held)
        held, hops = jumped, jumped.select(group, "node", "parent")
        if jumped.where("moved").isEmpty():
            return hops.withColumnRenamed("parent", "root")
