"""Embedding near-duplicates by PCA-ordered tiled comparison.

Unit vectors are rotated so that the leading coordinates carry most of their length. Tiles of
vectors are compared on the leading coordinates first; the norms of what is left bound the rest of
every product (Cauchy-Schwarz), and a pair goes on only while its cosine can still reach the
threshold.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .blocks import matrix, n_blocks, usable
from .common import column, staged
from .components import connected_components

TILE = 2048
# Tiles go to at most about so many groups, unless the vectors of a group would take more bytes.
GROUPS = 64
HELD_BYTES = 1 << 26
STRIP = 256
STRIPS = 256
SLACK = 1e-9


def rotation(sample: np.ndarray) -> np.ndarray:
    """Orthogonal matrix whose columns are the principal directions, strongest first."""
    values, vectors = np.linalg.eigh(sample.T @ sample)
    return vectors[:, np.argsort(-values, kind="stable")]


def stages(dim: int) -> list[int]:
    """Numbers of leading coordinates after which the bound is checked."""
    return sorted({max(1, dim // 4), max(1, dim // 2), dim})


class Tile:
    """Vectors of one tile: rotated unit vectors in PCA order, suffix norms, original directions."""

    def __init__(self, ids: np.ndarray, copies: np.ndarray, raw: np.ndarray, turn: np.ndarray) -> None:
        norms = np.sqrt(np.einsum("ij,ij->i", raw, raw))
        unit = (raw / norms[:, None]) @ turn
        order = np.argsort(unit[:, 0], kind="stable")
        self.ids, self.copies = ids[order], copies[order].astype(np.int64)
        self.raw, self.norms, self.unit = raw[order], norms[order], unit[order]
        squares = np.cumsum((self.unit**2)[:, ::-1], axis=1)[:, ::-1]
        self.suffix = np.sqrt(np.hstack([squares, np.zeros((len(squares), 1))]))


def tile_links(a: Tile, b: Tile, threshold: float, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``a`` and ``b`` whose cosine reaches the threshold; of one tile each pair once."""
    dim = a.unit.shape[1]
    marks = stages(dim)
    reach = _reach(threshold)
    out_a, out_b = [], []
    first = marks[0]
    lead_b = np.hstack([b.unit[:, :first], b.suffix[:, first : first + 1]])
    for start in range(0, len(a.ids), STRIP):
        stop = min(start + STRIP, len(a.ids))
        # Vectors are sorted by the first coordinate; a cosine bounds how far apart it can be.
        low = np.searchsorted(b.unit[:, 0], a.unit[start, 0] - reach, "left")
        high = np.searchsorted(b.unit[:, 0], a.unit[stop - 1, 0] + reach, "right")
        if low == high:
            continue
        lead_a = np.hstack([a.unit[start:stop, :first], a.suffix[start:stop, first : first + 1]])
        rows, cols = np.nonzero(lead_a @ lead_b[low:high].T >= threshold - SLACK)
        rows, cols = rows + start, cols + low
        if same:
            upper = rows < cols
            rows, cols = rows[upper], cols[upper]
        for at in range(0, len(rows), 1 << 18):
            r, k = rows[at : at + (1 << 18)], cols[at : at + (1 << 18)]
            product, done = np.einsum("ij,ij->i", a.unit[r, :first], b.unit[k, :first]), first
            for mark in marks[1:]:
                product = product + np.einsum("ij,ij->i", a.unit[r, done:mark], b.unit[k, done:mark])
                near = product + a.suffix[r, mark] * b.suffix[k, mark] >= threshold - SLACK
                r, k, product, done = r[near], k[near], product[near], mark
                if not len(r):
                    break
            cosine = np.einsum("ij,ij->i", a.raw[r], b.raw[k]) / (a.norms[r] * b.norms[k])
            out_a.append(r[cosine >= threshold])
            out_b.append(k[cosine >= threshold])
    none = np.zeros(0, dtype=np.int64)
    return np.concatenate([none, *out_a]), np.concatenate([none, *out_b])


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Numbers of the links that are enough to connect what all links connect."""
    parent = list(range(n))
    kept = []
    for i, (x, y) in enumerate(zip(a.tolist(), b.tolist(), strict=True)):
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        while parent[y] != y:
            parent[y] = y = parent[parent[y]]
        if x != y:
            parent[y] = x
            kept.append(i)
    return np.array(kept, dtype=np.int64)


def dealt(blocks: DataFrame, size: int) -> DataFrame:
    """(dim, group, moves, tile, ...): every group of ``size`` tiles, and beside it each tile that meets some of it.

    A tile is there once as a member of its own group and once for each group that holds tiles from
    itself to ``last``, as one that moves past the members. So it is copied by the number of groups,
    not of tiles.
    """
    own = F.floor(F.col("tile") / size).cast("int")
    members = blocks.select("dim", own.alias("group"), F.lit(False).alias("moves"), "tile", "last", "ids", "copies", "flat")
    met = F.explode(F.sequence(own, F.floor(F.col("last") / size).cast("int")))
    moving = blocks.select("dim", met.alias("group"), F.lit(True).alias("moves"), "tile", "last", "ids", "copies", "flat")
    return members.unionByName(moving)


def _reach(threshold: float) -> float:
    """How far apart unit vectors of at least this cosine can be in any coordinate."""
    return float(np.sqrt(max(0.0, 2 - 2 * threshold))) + 1e-6


def first_coordinate(turns: dict[int, np.ndarray]) -> Column:
    """The first principal coordinate of the unit vector; 0 for lengths without a rotation."""
    vector = F.col("vector")

    def dot(other: Column) -> Column:
        return F.aggregate(F.zip_with(vector, other, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)

    place = F.lit(0.0)
    for dim, turn in sorted(turns.items()):
        own = dot(F.array(*[F.lit(float(x)) for x in turn[:, 0]])) / F.sqrt(dot(vector))
        place = F.when(F.size(vector) == dim, own).otherwise(place)
    return F.nanvl(place, F.lit(0.0))


def strip_of(place: Column, turns: dict[int, np.ndarray], sampled: list[np.ndarray], strips: int) -> Column:
    """Number of the strip between quantiles of the sample's first coordinates."""
    at = np.sort([float(x @ turns[len(x)][:, 0] / np.linalg.norm(x)) for x in sampled])
    borders = sorted({at[len(at) * i // strips] for i in range(1, strips)}) if len(at) else []
    if not borders:
        return F.lit(0)
    return F.size(F.filter(F.array(*[F.lit(x) for x in borders]), lambda x: x <= place))


def near_vectors(
    vectors: DataFrame,
    threshold: float = 0.9,
    sample_rows: int = 4096,
    tile_rows: int = TILE,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
) -> DataFrame:
    """(vec_id, n_links, component_id, kept): one row per input row.

    n_links counts the other rows whose cosine, in double precision, reaches the threshold;
    component_id is the least vec_id reached by links, the row's own included; kept marks rows
    that are their component's least. Vectors that are null, empty or zero or hold null or
    non-finite components link with nothing, nor do vectors of unlike length. Rows that repeat an
    id are rows of their own. A null vec_id with a usable vector links but never names a component
    that has another id. Other columns are ignored.

    Equal vectors are one node with a weight, so copies are never paired. Different vectors lie in
    tiles ordered by the first principal coordinate. A task holds a group of tiles, and all tiles that
    are not too far from some of them in it move past the group. A pair of tiles sends one count per vector and a
    spanning forest of its links, at most two rows per vector, however dense the group. Rotation
    and borders are fitted on ``sample_rows`` vectors and change only the speed.
    """
    if not 0 < threshold <= 1:
        raise ValueError("threshold must be above 0 and at most 1")
    values = F.col(embedding).cast("array<double>")
    # 0.0 and -0.0 are one value, so that equal vectors meet.
    clean = F.transform(values, lambda x: F.when(x == 0, F.lit(0.0)).otherwise(x))
    able = usable(F.col(embedding)) & F.exists(values, lambda x: x != 0)
    rows = staged(
        vectors.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.when(able, clean).alias("vector")), "vectors"
    )
    # Nodes: distinct vectors, named by a hash of the vector and told apart by the vector itself.
    nodes = (
        rows.where("vector is not null")
        .groupBy("vector")
        .agg(F.count("*").alias("copies"), F.min("vec_id").alias("least"))
        .withColumn("id", F.monotonically_increasing_id())
    )
    nodes = staged(nodes, "vector-nodes")
    total = nodes.count()
    tiles = n_blocks(total, tile_rows)
    drawn = nodes.select("vector").orderBy(F.xxhash64("vector"), "vector").limit(sample_rows).toArrow()
    turns: dict[int, np.ndarray] = {}
    sampled = [np.asarray(x.values, dtype=np.float64) for x in drawn.column(0)]
    for dim in {len(x) for x in sampled}:
        own = np.array([x for x in sampled if len(x) == dim])
        turns[dim] = rotation(own / np.linalg.norm(own, axis=1, keepdims=True))

    # Strips of the first principal coordinate; full ones are split into several tiles.
    # The coordinate leaves a generator, so that it isn't computed again for every border of a strip.
    placed = nodes.withColumn("place", F.explode(F.array(first_coordinate(turns)))).withColumn(
        "strip", strip_of(F.col("place"), turns, sampled, min(tiles, STRIPS))
    )
    spans = sorted(
        placed.groupBy("strip").agg(F.count("*"), F.min("place"), F.max("place")).collect(), key=lambda r: r[0]
    )
    first_tile, last_tile, splits, at = {}, {}, {}, 0
    for strip, n, _, _ in spans:
        splits[strip], first_tile[strip] = n_blocks(n, tile_rows), at
        at += splits[strip]
    reach = _reach(threshold)
    for strip, _, _, high in spans:
        near = max(s for s, _, low, _ in spans if s >= strip and low <= high + reach)
        last_tile[strip] = first_tile[near] + splits[near] - 1

    def by_strip(values: dict[int, int]) -> Column:
        if not values:
            return F.lit(0)
        return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])[F.col("strip")]

    tile = by_strip(first_tile) + F.pmod(F.xxhash64("id"), by_strip(splits)).cast("int")
    blocks = staged(
        placed.withColumn("tile", tile)
        .groupBy("strip", "tile", F.size("vector").alias("dim"))
        .agg(F.collect_list(F.struct("id", "copies", "vector")).alias("rows"))
        .select(
            "tile",
            by_strip(last_tile).alias("last"),
            "dim",
            F.col("rows.id").alias("ids"),
            F.col("rows.copies").alias("copies"),
            F.flatten("rows.vector").alias("flat"),
        ),
        "vector-tiles",
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Members of a group come first and are held; each tile that moves is compared with them."""
        at, held = None, {}
        for batch in batches:
            for i in range(batch.num_rows):
                get = lambda name: np.asarray(column(batch, name)[i].values)  # noqa: B023, E731
                dim, group, moves, number, last = (
                    column(batch, x)[i].as_py() for x in ("dim", "group", "moves", "tile", "last")
                )
                if (dim, group) != at:
                    at, held = (dim, group), {}
                if moves and number in held:
                    a = held[number]
                else:
                    a = Tile(get("ids"), get("copies"), matrix(get("flat"), dim), turns.get(dim, np.eye(dim)))
                if not moves:
                    held[number] = a
                    continue
                for other_number, b in held.items():
                    if not number <= other_number <= last:
                        continue
                    same = number == other_number
                    r, k = tile_links(a, b, threshold, same)
                    if not len(r):
                        continue
                    count_a = np.bincount(r, b.copies[k], minlength=len(a.ids)).astype(np.int64)
                    count_b = np.bincount(k, a.copies[r], minlength=len(b.ids)).astype(np.int64)
                    tree = forest(len(a.ids) + (0 if same else len(b.ids)), r, k + (0 if same else len(a.ids)))
                    node = np.concatenate([a.ids[count_a > 0], b.ids[count_b > 0], a.ids[r[tree]]])
                    links = np.concatenate([count_a[count_a > 0], count_b[count_b > 0], np.zeros(len(tree), np.int64)])
                    other = np.concatenate([np.full(len(links) - len(tree), -1), b.ids[k[tree]]])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x.astype(np.int64)) for x in (node, links, other)], names=["node", "links", "other"]
                    )

    widest = tile_rows * max(turns, default=1) * 8
    size = max(1, min(-(-at // GROUPS), HELD_BYTES // widest))
    # Groups are few and large: several partitions for each, so that two of them seldom share one.
    joined = dealt(blocks, size).repartition(4 * max(1, -(-at // size)), "dim", "group")
    joined = joined.sortWithinPartitions("dim", "group", "moves", "tile")
    found = staged(joined.mapInArrow(compare, "node bigint, links bigint, other bigint"), "vector-links")
    counts = found.where("links > 0").groupBy(F.col("node").alias("id")).agg(F.sum("links").alias("links"))
    roots = connected_components(found.where("other >= 0").select("node", "other"))
    labelled = (
        nodes.select("id", "copies", "least", "vector")
        .join(counts, "id", "left")
        .join(roots, F.col("id") == roots.node, "left")
        .select(
            "vector",
            "least",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("root", "id").alias("root"),
        )
    )
    names = labelled.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = labelled.join(names, "root").select("vector", "n_links", "component_id")
    out = rows.join(classes, "vector", "left")
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        F.coalesce(F.col("vec_id") == F.coalesce("component_id", "vec_id"), F.lit(False)).alias("kept"),
    )
