"""Connected components of a link table, by alternating stars."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize

CHUNK_EDGES = 500_000


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of one partition, in chunks, as links to the least node reached within the chunk."""

    def stars(parent: dict[int, int]) -> pa.RecordBatch:
        pairs = [(node, find(parent, node)) for node in parent]
        pairs = [(a, b) for a, b in pairs if a != b]
        return pa.RecordBatch.from_arrays(
            [pa.array([p[i] for p in pairs], pa.int64()) for i in (0, 1)], names=["a", "b"]
        )

    def find(parent: dict[int, int], node: int) -> int:
        root = node
        while parent[root] != root:
            root = parent[root]
        while parent[node] != root:
            parent[node], node = root, parent[node]
        return root

    parent: dict[int, int] = {}
    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            parent.setdefault(a, a)
            parent.setdefault(b, b)
            x, y = find(parent, a), find(parent, b)
            if x != y:
                parent[max(x, y)] = min(x, y)
        if len(parent) > CHUNK_EDGES:
            yield stars(parent)
            parent = {}
    if parent:
        yield stars(parent)


def _least(df: DataFrame) -> DataFrame:
    return df.groupBy("a").agg(F.min("b").alias("least"))


def _star(links: DataFrame) -> DataFrame:
    """One large star (larger neighbours to the least neighbour), then one small star."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = _least(both).select("a", F.least("a", "least").alias("least"))
    large = (
        both.join(least, "a")
        .where("b > a and b <> least")
        .select(F.col("b").alias("a"), F.col("least").alias("b"))
        .distinct()
    )
    small = large.join(_least(large), "a")
    return (
        small.select("a", F.col("least").alias("b"))
        .unionByName(small.where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b")))
        .distinct()
    )


def connected_components(links: DataFrame) -> DataFrame:
    """(node long, root long) for every node that has a link; the root is the least node reached.

    ``links`` has two long columns, any order, repeats and self links allowed; links with a null
    end are ignored. Each round moves nodes to smaller neighbours by two joins on the node, so a
    hub with a third of all links is an ordinary skewed join, and ends in a checkpoint. The number
    of rounds follows the logarithm of the longest chain. Only one count and one checksum per
    round reach the driver.
    """
    first, second = links.columns
    clean = links.select(F.col(first).cast("bigint").alias("a"), F.col(second).cast("bigint").alias("b"))
    clean = clean.where("a is not null and b is not null and a <> b")
    edges = materialize(clean.mapInArrow(_contract, "a bigint, b bigint").distinct())
    state = None
    while True:
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now == state or not now[0]:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                edges.select(F.col("b").alias("node"), F.col("b").alias("root"))
            ).distinct()
        state = now
        edges = materialize(_star(edges))
