"""Connected components of an edge list, by repeated contraction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrystone.session import materialize, release


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", jumps: int = 2) -> DataFrame:
    """Return (node, component) for every node of ``edges``; component is the smallest node id reachable.

    Each round every node points at its smallest neighbour (or itself), pointers are doubled ``jumps`` times, edges are
    redrawn between the nodes pointed at, and loops and repeats are dropped. A chain shrinks by 2**jumps per round, so
    rounds grow with the logarithm of the longest chain. Minima are partially aggregated, so a hub's edges never meet in
    one task before they are reduced; joins are left to AQE, which splits a hub. Null ends are ignored; an empty edge
    list gives an empty result.
    """
    live = (
        edges.select(F.col(a).alias("u"), F.col(b).alias("v"))
        .where(F.col("u").isNotNull() & F.col("v").isNotNull())
        .select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
        .distinct()
    )
    live = materialize(live)
    mapping = materialize(
        live.select(F.explode(F.array("u", "v")).alias("node")).distinct().select("node", F.col("node").alias("component"))
    )
    held = live
    live = live.where("u <> v")
    while not live.isEmpty():
        both = live.select("u", "v").unionByName(live.select(F.col("v").alias("u"), F.col("u").alias("v")))
        parent = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("p"))
        parent = near = materialize(parent)
        for _ in range(jumps):
            up = parent.select(F.col("u").alias("p"), F.col("p").alias("pp"))
            parent = parent.join(up, "p").select("u", F.col("pp").alias("p"))
        parent = materialize(parent)
        release(near)
        before = mapping
        mapping = materialize(
            mapping.join(parent.select(F.col("u").alias("component"), "p"), "component", "left").select(
                "node", F.coalesce("p", "component").alias("component")
            )
        )
        release(before)
        left = live.join(parent, "u").select(F.col("p").alias("u"), "v")
        moved = left.join(parent.select(F.col("u").alias("v"), "p"), "v").select("u", F.col("p").alias("v"))
        before = held
        live = held = materialize(
            moved.where("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
        )
        release(before, parent)
    release(held)
    return mapping


def star_edges(pairs: DataFrame, node: str, key: str | list[Column]) -> DataFrame:
    """Edges (a, b) that join every node of a key to the key's smallest node; as many edges as memberships at most."""
    keys = [key] if isinstance(key, str) else list(key)
    hub = pairs.groupBy(*keys).agg(F.min(node).alias("_hub"))
    return pairs.join(hub, keys).where(F.col(node) != F.col("_hub")).select(F.col("_hub").alias("a"), F.col(node).alias("b"))
