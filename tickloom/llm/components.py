"""Connected components of links that are too many for one machine."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import spread, stored

#: Links that one task settles; rounds over all cores go on while there are more.
PART = 1 << 20


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())


def smallest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """For each of ``n`` nodes the smallest that the links (a, b) reach."""
    label = np.arange(n)
    while True:
        a, b = label[a], label[b]
        apart = a != b
        if not apart.any():
            return label
        a, b = np.maximum(a[apart], b[apart]), np.minimum(a[apart], b[apart])
        np.minimum.at(label, a, b)
        while (label[label] != label).any():
            label = label[label]


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All links (a, b) to rows (id, component)."""
    rows = [x for x in batches if x.num_rows]
    if not rows:
        return
    links = pa.Table.from_batches(rows)
    kind = links.schema.types[0]
    ids, at = np.unique(np.concatenate([links.column(i).to_numpy() for i in range(2)]), return_inverse=True)
    label = smallest(at[: links.num_rows], at[links.num_rows :], len(ids))
    for some in np.array_split(np.arange(len(ids)), max(1, len(ids) >> 16)):
        yield pa.RecordBatch.from_arrays([pa.array(ids[some], kind), pa.array(ids[label[some]], kind)], names=["id", "component"])


def components(edges: DataFrame, rounds: int = 60, part: int = PART) -> DataFrame:
    """(id, component) of every id in the links (a, b); component is the smallest id that can be reached.

    Alternates large-star and small-star until the links are stars around the smallest ids, or at most ``part``, which one
    task settles. Every step groups with partial minima and writes its links, so neither lineage nor a hot centre's
    neighbours gather in one place. Null ends, loops and repeated links are ignored; no links give no rows.
    """
    links = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b"))).distinct()
    links = stored(links)
    kind = links.schema["a"].dataType.simpleString()
    before = _mark(links)
    for _ in range(rounds):
        if before[0] <= part:
            return stored(links.repartition(1).mapInArrow(_settle, f"id {kind}, component {kind}"))
        # large-star: every larger neighbour goes to the smallest of the node and its neighbours
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(spread(least, "a"), "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()
        # small-star: the smaller neighbours of a node, and itself, go to the smallest of them
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        moved = down.join(spread(least, "a"), "a").where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        links = stored(moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct())
        after = _mark(links)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return links.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(links.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())
