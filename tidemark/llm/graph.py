"""Connected components by contraction, for graphs of any size and with hubs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import stored


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` for each node that an edge names; component is its smallest node.

    Each round sends every node to the neighbour (or itself) that comes first in a hashed order, follows
    these pointers twice, and replaces the edges by those between the nodes that were reached. A hashed
    order halves any graph, also a chain, in each round or so, and a star takes two rounds. Minima are
    combined before the shuffle, and lookups join two stored tables, so that a hub's rows are split.
    Each round's edges are written out: no lineage grows and a lost executor costs one round at most.

    Null ends and loops say nothing and are ignored; no edges give no rows.
    """
    edges = edges.select(F.col(a).alias("a"), F.col(b).alias("b"))
    nodes = stored(
        edges.where("a is not null and b is not null").select(F.explode(F.array("a", "b")).alias("node")).distinct(),
        "nodes",
    )
    edges = stored(edges.where("a <> b").distinct(), "edges")
    label = nodes.select("node", F.col("node").alias("label"))
    first = not edges.isEmpty()
    while first:
        both = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a")))
        order = F.xxhash64("b")
        best = both.groupBy("a").agg(F.min(F.struct(order.alias("h"), F.col("b").alias("to"))).alias("n"))
        own = F.struct(F.xxhash64("a").alias("h"), F.col("a").alias("to"))
        step = stored(best.select(F.col("a").alias("at"), F.least("n", own)["to"].alias("to")), "pointers")
        for _ in range(2):
            ahead = step.select(F.col("at").alias("to"), F.col("to").alias("next"))
            step = step.join(ahead, "to", "left").select("at", F.coalesce("next", "to").alias("to"))
        step = stored(step, "reached")
        ends = [step.select(F.col("at").alias(c), F.col("to").alias(f"to_{c}")) for c in ("a", "b")]
        moved = reduce(lambda left, right: left.join(right, right.columns[0]), ends, edges)
        low, high = F.least("to_a", "to_b"), F.greatest("to_a", "to_b")
        edges = stored(moved.select(low.alias("a"), high.alias("b")).where("a <> b").distinct(), "edges")
        label = label.join(step.withColumnRenamed("at", "label"), "label", "left").select(
            "node", F.coalesce("to", "label").alias("label")
        )
        first = not edges.isEmpty()
    label = stored(label, "labels")
    smallest = stored(label.groupBy("label").agg(F.min("node").alias("component")), "smallest")
    return label.join(smallest, "label").select("node", "component")
