"""Connected components of a link table by alternating star contraction."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillmark.llm.tables import cut

#: Links of a node that one task joins, and the number of nodes that may have more.
HUB_LINKS, HUBS = 1000, 10_000


def forest(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (node, smallest node of its component) that connect what the given links connect."""
    nodes, at = np.unique(np.concatenate([left, right]), return_inverse=True)
    a, b = at[: len(left)], at[len(left) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    while (label[label] != label).any():
        label = label[label]
    keep = label != np.arange(len(nodes))
    return nodes[keep], nodes[label[keep]]


def _local_forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        node, root = forest(batch.column(0).to_numpy(), batch.column(1).to_numpy())
        yield pa.record_batch([pa.array(node), pa.array(root)], names=["a", "b"])


def _stars(links: DataFrame, large: bool, hub: int) -> DataFrame:
    """One half-step: neighbours above (large) or not above (small) a node move to its smallest neighbour.

    A node with more than ``hub`` links is joined in as many pieces as it has
    times that; there are few of them, so their table is broadcast.
    """
    both = links.union(links.select("b", "a")).toDF("u", "v") if large else links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    lowest = both.groupBy("u").agg(F.min("v").alias("low"), F.ceil(F.count(F.lit(1)) / hub).cast("int").alias("pieces"))
    lowest = lowest.select(F.col("u").alias("w"), F.least("u", "low").alias("m"), "pieces")
    hubs = lowest.filter("pieces > 1").select(F.col("w").alias("h"), F.col("pieces").alias("parts"))
    piece = F.pmod(F.xxhash64("v"), F.coalesce("parts", F.lit(1))).cast("int")
    dealt = both.join(F.broadcast(hubs), F.col("u") == F.col("h"), "left").select("u", "v", piece.alias("piece"))
    copies = lowest.select("w", "m", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("copy"))
    met = dealt.join(copies, (F.col("u") == F.col("w")) & (F.col("piece") == F.col("copy")))
    if large:
        moved = met.filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        moved = met.select(F.col("v").alias("a"), F.col("m").alias("b")).union(lowest.select(F.col("w").alias("a"), F.col("m").alias("b")))
    return moved.filter("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of the links ``(a, b)`` of longs; root is its smallest reachable node.

    Links may repeat, point either way or to the node itself; nodes without a
    link to another node are not returned. Each round is two joins on a node
    and ends in a table in the shared folder; the number of rounds grows with
    the logarithm of the number of nodes. Batches are first reduced to forests
    inside their tasks, so that a dense group sends about one row a node.
    """
    edges = cut(links.select("a", "b").filter("a <> b").mapInArrow(_local_forests, "a long, b long").distinct(), "links")
    known = None
    # At most HUBS nodes or so have as many links.
    hub = max(HUB_LINKS, 2 * edges.count() // HUBS)
    while True:
        edges = cut(_stars(_stars(edges, True, hub), False, hub), "links")
        state = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if state == known:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(edges.select("b", "b").distinct())
        known = state
