"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints at most 2r bits apart have a value within r bits of both. So every fingerprint
emits all variants within r bits of itself; fingerprints that share a variant meet in a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import slices, staged, texts
from .components import connected_components
from .line_dedup import FEW, band_keys, in_buckets, rest_pairs

SEED = 42
SHINGLE = 3
STEP = 1 << 16
BANDS = 8


def fingerprint(text: str | None, words: int = SHINGLE) -> int:
    """64-bit SimHash of a whole text over its word shingles, repeats included.

    A-Z are lower-cased, words are runs without ASCII white space. With fewer words than a shingle
    has, all of them are the one shingle; without a word (or a null text) the fingerprint is 0.
    """
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    sizes = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    n = max(1, len(parts) - words + 1)
    last = ends[min(words, len(parts)) - 1 :][:n]
    ones = np.zeros(64, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, STEP):
        spans = zip(starts[at : at + STEP].tolist(), last[at : at + STEP].tolist(), strict=False)
        h = np.array([digest(joined[a:b], SEED) for a, b in spans], dtype=np.uint64)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    value = 0
    for bit in np.flatnonzero(2 * ones > n):
        value |= 1 << int(bit)
    return value


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = SHINGLE) -> DataFrame:
    """(doc_id, fp long): the fingerprint's 64 bits as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            values = np.array([fingerprint(x, words) for x in texts(batch)], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values)], names=["doc_id", "fp"])

    source = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return source.mapInArrow(run, "doc_id bigint, fp bigint")


def ball(radius: int) -> np.ndarray:
    """Masks of all flips of at most ``radius`` bits."""
    masks = [sum(1 << b for b in bits) for k in range(radius + 1) for bits in combinations(range(64), k)]
    return np.array(masks, dtype=np.uint64).view(np.int64)


def variants(prints: DataFrame, radius: int) -> DataFrame:
    """(variant, fp): every value within ``radius`` bits of a fingerprint."""
    masks = ball(radius)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2048):
            fp = np.asarray(batch.column(0), dtype=np.int64)
            near = (fp[:, None] ^ masks[None, :]).ravel()
            yield pa.RecordBatch.from_arrays(
                [pa.array(near), pa.array(np.repeat(fp, len(masks)))], names=["variant", "fp"]
            )

    return prints.mapInArrow(run, "variant bigint, fp bigint")


def links(prints: DataFrame, distance: int = 2) -> DataFrame:
    """(a, b): links between distinct fingerprints that connect whatever is ``distance`` bits apart.

    Fingerprints that share a variant are at most 2r bits apart from each other. With an even
    distance the chain of neighbours in a bucket therefore connects the whole bucket; an odd one
    verifies each colliding pair of a bucket. A bucket holds only distinct fingerprints around one
    value, at most 65 of them for r = 1, whatever the number of copies.
    """
    if not 0 <= distance <= 4:
        raise ValueError("distance from 0 to 4")
    radius = (distance + 1) // 2
    near = variants(prints, radius)
    if distance % 2 == 0:
        ordered = Window.partitionBy("variant").orderBy("fp")
        met = near.select(F.lag("fp").over(ordered).alias("a"), F.col("fp").alias("b")).where("a is not null")
    else:
        held = near.groupBy("variant").agg(F.sort_array(F.collect_list("fp")).alias("fps")).where("size(fps) > 1")
        met = held.select(F.explode("fps").alias("a"), "fps").select("a", F.explode("fps").alias("b")).where("a < b")
    return met.distinct().where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance)


def near_duplicates(
    docs: DataFrame, distance: int = 2, doc_id: str = "doc_id", text: str = "text", words: int = SHINGLE
) -> DataFrame:
    """(doc_id, fp long, component_id): one row per input row.

    component_id is the least doc_id that links reach. Copies share a fingerprint and are one node
    of the link graph. Null and blank texts have fingerprint 0 and link like any other. Rows with
    a null doc_id are kept; a group of nothing but null ids has a null component. Repeated ids are
    separate rows. Other columns are ignored.
    """
    prints = staged(fingerprints(docs, doc_id, text, words), "fingerprints")
    distinct = prints.groupBy("fp").agg(F.min("doc_id").alias("first"))
    roots = connected_components(links(distinct.select("fp"), distance))
    labelled = distinct.join(roots, distinct.fp == roots.node, "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    least = labelled.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = labelled.join(least, "root").select("fp", "component_id")
    return prints.join(classes, "fp").select("doc_id", "fp", "component_id")


def near_duplicate_rows(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint as 16 hex digits, component_id)."""
    found = near_duplicates(docs)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """Sorted hashes of the different word shingles of a text, words as in ``fingerprint``."""
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    digest = xxhash.xxh64_intdigest
    n = max(1, len(parts) - words + 1) if parts else 0
    return np.unique(np.array([digest(b" ".join(parts[i : i + words]), SEED) for i in range(n)], dtype=np.uint64))


def print_links(prints: DataFrame, distance: int) -> DataFrame:
    """(a, b): ids linked by SimHash, from (id, fp) rows; the least id of a fingerprint stands for it."""
    own = prints.groupBy("fp").agg(F.min("id").alias("least"))
    same = prints.select("id", "fp").distinct().join(own, "fp").where("id <> least")
    near = links(own.select("fp"), distance)
    near = near.join(own.select(F.col("fp").alias("a"), F.col("least").alias("x")), "a")
    near = near.join(own.select(F.col("fp").alias("b"), F.col("least").alias("y")), "b").where("x <> y")
    return same.select(F.col("least").alias("a"), F.col("id").alias("b")).unionByName(
        near.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
    )


def near_copies(docs: DataFrame, words: int, similarity: float, distance: int = 2) -> DataFrame:
    """(doc_id, component_id): one row per input row.

    Linked are texts whose SimHash differs in at most ``distance`` bits, as in ``near_duplicates``,
    and texts of that Jaccard over shingles of ``words`` words. For the latter, texts that agree on
    two minima of one of BANDS bands meet. Where more than FEW do, those that agree on further
    minima are compared first (more than FEW of these with the least member and the next ones in
    the orders of two hashes), and then all pairs that no group holds yet. Pairs that meet are
    verified by the exact coefficient. Texts of equal shingles are one node, blank and null ones too.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            sets = [shingle_set(x, words) for x in texts(batch)]
            fps = np.array([fingerprint(x) for x in texts(batch)], dtype=np.uint64).view(np.int64)
            node = [xxhash.xxh3_64_intdigest(x.tobytes()) for x in sets]
            keys = np.zeros((len(sets), BANDS), dtype=np.int64)
            full = np.array([len(x) > 0 for x in sets], dtype=bool)
            if full.any():
                sizes = np.array([len(x) for x in sets])[full]
                keys[full] = band_keys(np.concatenate(sets), np.cumsum(sizes) - sizes, BANDS, 3).view(np.int64)
            lists = [k.tolist() if f else [] for k, f in zip(keys, full, strict=True)]
            marks = [batch.column(0), batch.column(1), pa.array(np.array(node, dtype=np.uint64).view(np.int64))]
            yield pa.RecordBatch.from_arrays(
                [*marks, pa.array(fps), pa.array([len(x) for x in sets], pa.int32()), pa.array(lists, pa.list_(pa.int64()))],
                names=["doc_id", "text_hash", "id", "fp", "n", "keys"],
            )

    def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            lists = [shingle_set(x, words).view(np.int64).tolist() for x in texts(batch)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(lists, pa.list_(pa.int64()))], names=["id", "shingles"]
            )

    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    schema = "doc_id bigint, text_hash bigint, id bigint, fp bigint, n int, keys array<bigint>"
    prints = staged(source.mapInArrow(run, schema), "shingles")
    nodes = prints.groupBy("id").agg(
        F.min(F.struct("doc_id", "text_hash")).alias("place"), F.first("n").alias("n"), F.first("keys").alias("keys")
    )
    nodes = staged(nodes.select("id", "place.*", "n", "keys"), "shingle-nodes")
    met = in_buckets(nodes.select("id", "n", F.explode("keys").alias("bits")))
    met = staged(met.select("top", "tops", "key", "id", "n", "size"), "shingle-buckets")
    few, many = met.where(F.col("size").between(2, FEW)), met.where(F.col("size") > FEW)
    pairs = [few.join(few.select("key", F.col("id").alias("other")), "key").select("id", "other")]
    pairs.append(many.select("id", F.min("id").over(Window.partitionBy("key")).alias("other")))
    for order in (F.col("id"), F.xxhash64("id")):
        by = Window.partitionBy("key").orderBy(order)
        pairs += [many.select("id", F.lag("id", step).over(by).alias("other")) for step in (1, 2)]
    every = pairs[0]
    for more in pairs[1:]:
        every = every.unionByName(more)
    every = every.where("id <> other").select(F.least("id", "other").alias("a"), F.greatest("id", "other").alias("b"))

    def verified(pairs: DataFrame) -> DataFrame:
        wanted = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct()
        places = nodes.join(wanted, "id").select("id", "doc_id", "text_hash")
        held = source.join(places, ["doc_id", "text_hash"]).select("id", "text").mapInArrow(
            sets_of, "id bigint, shingles array<bigint>"
        )
        held = staged(held.dropDuplicates(["id"]), "shingle-sets")
        both = pairs.join(held.select(F.col("id").alias("a"), F.col("shingles").alias("x")), "a").join(
            held.select(F.col("id").alias("b"), F.col("shingles").alias("y")), "b"
        )
        both = both.withColumn("common", F.size(F.array_intersect("x", "y")))
        reached = F.col("common") >= similarity * (F.size("x") + F.size("y") - F.col("common")) - 1e-9
        return both.where(reached).select("a", "b")

    first = verified(staged(every.distinct(), "shingle-pairs")).unionByName(print_links(prints, distance))
    first = staged(first, "shingle-links")
    crowded = met.where(F.col("tops") > FEW).select("top", "id", "n")
    if crowded.isEmpty():
        roots = connected_components(first)
    else:
        groups = staged(connected_components(first), "shingle-groups")
        label = groups.select(F.col("node").alias("id"), "root")
        labelled = crowded.join(label, "id", "left").withColumn("root", F.coalesce("root", "id"))
        rest = staged(rest_pairs(labelled, similarity), "shingle-rest")
        roots = connected_components(first.unionByName(verified(rest)))
    labelled = nodes.join(roots, nodes.id == roots.node, "left").select("id", "doc_id", F.coalesce("root", "id").alias("root"))
    least = labelled.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    classes = labelled.join(least, "root").select("id", "component_id")
    return prints.join(classes, "id").select("doc_id", "component_id")


def keep_representatives(
    docs: DataFrame, distance: int = 2, words: int = SHINGLE, similarity: float | None = None
) -> DataFrame:
    """One document of each group: the one with the least doc_id; columns unchanged.

    Groups are those of ``near_copies`` if a similarity is given, which also links by SimHash, else
    of ``near_duplicates``.
    Where that id is repeated, rows of equal text stay once and other texts stay too. Rows without
    an id can't stand for a group and are kept.
    """
    own = docs.where("doc_id is not null")
    if similarity is None:
        groups = near_duplicates(own, distance, words=words)
    else:
        groups = near_copies(own, words, similarity, distance)
    counted = groups.groupBy("doc_id").agg(
        F.count("*").alias("rows of it"), F.max(F.col("doc_id") == F.col("component_id")).alias("stands")
    )
    ids = counted.where("stands").select(F.col("doc_id").alias("kept id"), "`rows of it`")
    kept = docs.join(ids, F.col("doc_id") == F.col("kept id"))
    once = kept.where("`rows of it` = 1").select(*docs.columns)
    repeated = kept.where("`rows of it` > 1").select(*docs.columns).dropDuplicates(["doc_id", "text"])
    return once.unionByName(repeated).unionByName(docs.where("doc_id is null"))
