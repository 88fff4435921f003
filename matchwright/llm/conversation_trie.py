"""Prefix trie of conversations from padded matrices of turn ids.

Conversations are cut into blocks of a fixed number of turns and dealt into range shards. A shard
sorts its padded matrix of turn ids by ``lexsort``; the columns in which neighbouring rows differ,
OR-accumulated from left to right, mark where the nodes of every depth start, and ``reduceat`` sums
over them. Nodes that may reach over the edge of a shard are the only ones that meet again.

Everything told of a node is a sum or a minimum over its members. What a subtree saves is too: the
value of each node is given to its smallest member, whose values from one depth downwards then count
for all nodes above. So the shards run twice, first for members, then for sums over subtrees.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import column, staged

TURNS = "conv_id bigint, part bigint, pos bigint, a bigint, b bigint, size bigint"
WIDTH, SHARD_ROWS, HEAD, CHUNK_IDS = 64, 16_384, 8, 1_024
NODE = "shard bigint, open boolean, depth bigint, k1 bigint, k2 bigint"
COUNTED = f"{NODE}, n_convs bigint, rep bigint, n_ends bigint, size bigint"
SUMMED = (
    f"{NODE}, p1 bigint, p2 bigint, parent bigint, n_convs bigint, rep bigint, n_children bigint, n_leaves bigint, "
    "saved bigint, sha string, ids array<bigint>"
)
NO_ENDS = hashlib.sha256(b"").hexdigest()


def shared_turns(conv_id: Column) -> tuple[Column, Column]:
    """The conversation whose first turns a conversation takes, and how many of them."""
    return conv_id - conv_id % 5, F.crc32(conv_id.cast("string").cast("binary")) % 9


def _arrow(types: str) -> pa.Schema:
    kinds = {"bigint": pa.int64(), "boolean": pa.bool_(), "string": pa.string(), "array<bigint>": pa.list_(pa.int64())}
    return pa.schema([(name, kinds[kind]) for name, kind in (f.rsplit(" ", 1) for f in types.split(", "))])


def numbered(conversations: DataFrame) -> DataFrame:
    """(conv_id, d, a, b, size): turns numbered from 1, a 128-bit id and the bytes of the text.

    The order is by turn (null first), role and the MD5 of the text. Rows are sorted in ranges, so
    that a very long conversation lies in many tasks; each numbers its own rows, and conversations
    that reach over an edge get what lies in the tasks before added.
    """
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest")]
    rows = (
        conversations.where(F.col("conv_id").isNotNull())
        .select(
            F.col("conv_id").cast("bigint").alias("conv_id"),
            F.col("turn"),
            role.alias("role"),
            F.md5(text.cast("binary")).alias("digest"),
            F.xxhash64(role, text).alias("a"),
            F.xxhash64(F.lit("turn"), text, role).alias("b"),
            F.octet_length(text).cast("bigint").alias("size"),
        )
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("conv_id", "a", "b", "size")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, count = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            conv = column(batch, "conv_id").to_numpy()
            if not len(conv):
                continue
            at = np.arange(len(conv))
            new = np.r_[True, conv[1:] != conv[:-1]]
            pos = at - np.maximum.accumulate(np.where(new, at, 0)) + 1
            if conv[0] == last:
                pos[conv == last] += count
            last, count = conv[-1], int(pos[-1])
            columns = [conv, np.full(len(conv), part), pos, *(column(batch, c).to_numpy() for c in ("a", "b", "size"))]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=_arrow(TURNS))

    turns = staged(rows.mapInArrow(run, TURNS), "turns")
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        turns.groupBy("conv_id", "part")
        .agg(F.max("pos").alias("n"))
        .withColumn("offset", F.sum("n").over(before))
        .where(F.col("offset") > 0)
    )
    return turns.join(offsets.drop("n"), ["conv_id", "part"], "left").select(
        "conv_id", (F.col("pos") + F.coalesce("offset", F.lit(0))).alias("d"), "a", "b", "size"
    )


def rebuilt(turns: DataFrame, rule: Callable[[Column], tuple[Column, Column]] = shared_turns) -> DataFrame:
    """(conv_id, n, d, a, b, size): turns after each conversation has taken another's first turns.

    ``n`` is the conversation's number of turns; one without turns has a single row with d null.
    At most 8 turns of a conversation are taken, by as many others as the rule lets.
    """
    base, h = rule(F.col("conv_id"))
    sizes = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("own"))
    convs = (
        sizes.select("conv_id", "own", base.alias("base"), h.alias("h"))
        .join(sizes.select(F.col("conv_id").alias("base"), F.col("own").alias("theirs")), "base", "left")
        .withColumn("taken", F.least("h", F.coalesce("theirs", F.lit(0))))
        .withColumn("n", F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0)))
    )
    convs = staged(convs.select("conv_id", "base", "h", "taken", "n"), "convs")
    fields = ["conv_id", "n", "d", "a", "b", "size"]
    heads = turns.where(F.col("d") <= 8).withColumnRenamed("conv_id", "base")
    first = convs.join(heads, "base").where(F.col("d") <= F.col("h")).select(*fields)
    rest = (
        turns.join(convs, "conv_id")
        .where(F.col("d") > F.col("h"))
        .withColumn("d", F.col("d") - F.col("h") + F.col("taken"))
        .select(*fields)
    )
    bare = convs.where(F.col("n") == 0).select("conv_id", "n", *(F.lit(None).cast("bigint").alias(c) for c in fields[2:]))
    return first.unionByName(rest).unionByName(bare)


def in_blocks(turns: DataFrame, width: int = WIDTH) -> DataFrame:
    """(conv_id, n, block, s1, s2, x, y, sizes): at most ``width`` turns of a conversation in a row.

    x and y are two 64-bit hashes of each turn at its depth; their XOR over the first d turns names
    the node of depth d. s1 and s2 are this name for the turns before the block.
    """
    block = F.coalesce(F.floor((F.col("d") - 1) / width), F.lit(0)).alias("block")
    items = F.struct("d", F.xxhash64("a", "d").alias("x"), F.xxhash64("b", "d").alias("y"), "size")
    rows = turns.groupBy("conv_id", "n", block).agg(
        F.sort_array(F.collect_list(F.when(F.col("d").isNotNull(), items))).alias("turns"),
        F.coalesce(F.bit_xor(F.xxhash64("a", "d")), F.lit(0)).alias("x_all"),
        F.coalesce(F.bit_xor(F.xxhash64("b", "d")), F.lit(0)).alias("y_all"),
    )
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return rows.select(
        "conv_id",
        "n",
        "block",
        F.coalesce(F.bit_xor("x_all").over(before), F.lit(0)).alias("s1"),
        F.coalesce(F.bit_xor("y_all").over(before), F.lit(0)).alias("s2"),
        F.col("turns.x").alias("x"),
        F.col("turns.y").alias("y"),
        F.col("turns.size").alias("sizes"),
    )


def _dense(*keys: np.ndarray) -> np.ndarray:
    """Numbers from 0 for the different tuples of equally long arrays."""
    order = np.lexsort(keys)
    new = np.zeros(len(order), dtype=np.int64)
    for key in keys:
        new[1:] |= key[order][1:] != key[order][:-1]
    out = np.empty(len(order), dtype=np.int64)
    out[order] = np.cumsum(new)
    return out


class Shard:
    """Neighbouring block rows as one sorted, padded matrix."""

    def __init__(self, rows: pa.RecordBatch, width: int, head: int) -> None:
        self.rows, self.width = rows, width
        conv, block, s1, s2 = (column(rows, c).to_numpy() for c in ("conv_id", "block", "s1", "s2"))
        x, self.fill, lengths = self.lists("x")
        y = self.lists("y")[0]
        columns = int(lengths.max())
        ids = np.zeros((len(conv), columns), dtype=np.int64)
        ids[self.fill] = _dense(x, y) + 1
        group = _dense(block, s1, s2)
        self.order = np.lexsort((conv, *(ids[:, j] for j in range(columns - 1, -1, -1)), group))
        ids, group = ids[self.order], group[self.order]
        change = np.ones((len(conv), columns + 1), dtype=bool)
        change[1:, 0] = group[1:] != group[:-1]
        change[1:, 1:] = ids[1:] != ids[:-1]
        self.starts = np.logical_or.accumulate(change, axis=1)
        self.lengths = lengths[self.order]
        self.conv, self.block = conv[self.order], block[self.order]
        self.names = [self.spread(v, s)[self.order] for v, s in ((x, s1), (y, s2))]
        # The first and the last row in the order of the shards, and all that share their head.
        edges = np.isin(self.order, (0, len(conv) - 1))
        self.edge = [self.any_of(j, edges) if j <= head else None for j in range(min(head, columns) + 1)]

    def lists(self, name: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Values of a list column, the cells of the padded matrix they fill, their number a row."""
        array = column(self.rows, name)
        ends = array.offsets.to_numpy()
        lengths = np.diff(ends)
        values = array.values.to_numpy(zero_copy_only=False)[ends[0] : ends[-1]]
        return values, np.arange(lengths.max(initial=0)) < lengths[:, None], lengths

    def spread(self, values: np.ndarray, start: np.ndarray) -> np.ndarray:
        """Names of every row's nodes, its depth in the block as column."""
        out = np.zeros((len(start), self.fill.shape[1] + 1), dtype=np.int64)
        out[:, 0] = start
        out[:, 1:][self.fill] = values
        return np.bitwise_xor.accumulate(out, axis=1)

    def runs(self, j: int) -> np.ndarray:
        return np.flatnonzero(self.starts[:, min(j, self.starts.shape[1] - 1)])

    def any_of(self, j: int, marked: np.ndarray) -> np.ndarray:
        """Rows in a run of depth j that holds a marked row."""
        return np.repeat(np.logical_or.reduceat(marked, self.runs(j)), np.diff(np.r_[self.runs(j), len(marked)]))

    def nodes(self) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """For every depth in the block: its number, starts of all runs, which are nodes, which may be shared."""
        for j in range(self.starts.shape[1]):
            runs = self.runs(j)
            real = self.lengths[runs] >= j
            if j == 0 or real.any():
                yield j, runs, real, self.edge[min(j, len(self.edge) - 1)][runs]

    def depth(self, j: int, runs: np.ndarray) -> np.ndarray:
        return self.block[runs] * self.width + j


def _sharded(blocks: DataFrame, run: Callable[[Shard, int], Iterator[pa.RecordBatch]], types: str, width: int, rows: int, head: int) -> DataFrame:
    """Every shard through ``run``, with a number: rows in the order of their first turns."""
    key = [F.col("block"), F.col("s1"), F.col("s2"), F.col("head"), F.col("conv_id")]
    own = F.transform(F.slice(F.arrays_zip("x", "y"), 1, head), lambda t: F.array(t["x"], t["y"]))
    dealt = blocks.withColumn("head", F.flatten(own)).repartitionByRange(*key).sortWithinPartitions(*key).drop("head")

    def every(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, n = TaskContext.get().partitionId() << 32, [], 0

        def cut() -> Iterator[pa.RecordBatch]:
            nonlocal number, held, n
            table = pa.Table.from_batches(held).combine_chunks()
            held, n = [], 0
            for batch in table.to_batches():
                for start in range(0, batch.num_rows, rows):
                    yield from run(Shard(batch.slice(start, rows), width, head), number)
                    number += 1

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                n += batch.num_rows
            if n >= rows:
                yield from cut()
        if held:
            yield from cut()

    return dealt.mapInArrow(every, types)


def _batch(types: str, **columns) -> pa.RecordBatch:
    schema = _arrow(types)
    n = len(columns["depth"])
    fill = [columns.get(f.name) for f in schema]
    return pa.RecordBatch.from_arrays(
        [
            pa.nulls(n, f.type) if c is None else pa.array(np.full(n, c) if np.isscalar(c) else c, f.type)
            for f, c in zip(schema, fill, strict=True)
        ],
        schema=schema,
    )


def _count(shard: Shard, number: int) -> Iterator[pa.RecordBatch]:
    """Members, smallest member and members that end, for every node below the root."""
    values, fill, _ = shard.lists("sizes")
    sizes = np.zeros(fill.shape, dtype=np.int64)
    sizes[fill] = values
    sizes, n = sizes[shard.order], column(shard.rows, "n").to_numpy()[shard.order]
    for j, runs, real, edge in shard.nodes():
        if j == 0:
            continue
        depth = shard.depth(j, runs)
        ends = np.add.reduceat((n == shard.block * shard.width + j).astype(np.int64), runs)
        members = np.diff(np.r_[runs, len(n)])
        yield _batch(
            COUNTED,
            shard=number,
            open=edge[real],
            depth=depth[real],
            k1=shard.names[0][runs, j][real],
            k2=shard.names[1][runs, j][real],
            n_convs=members[real],
            rep=np.minimum.reduceat(shard.conv, runs)[real],
            n_ends=ends[real],
            size=sizes[runs, j - 1][real],
        )


def _digest(ids: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, ids.tolist())).encode()).hexdigest()


def _sum(shard: Shard, number: int) -> Iterator[pa.RecordBatch]:
    """All sums over members, for every node; parts only of nodes that may be shared."""
    facts = {c: column(shard.rows, c).to_numpy()[shard.order] for c in ("n", "f", "leaf", "rest")}
    depths, _, lengths = shard.lists("depths")
    owner = np.repeat(np.arange(len(lengths)), lengths)
    below = np.zeros((len(lengths), shard.starts.shape[1]), dtype=np.int64)
    below[owner, depths - column(shard.rows, "block").to_numpy()[owner] * shard.width] = shard.lists("values")[0]
    below = np.cumsum(below[shard.order][:, ::-1], axis=1)[:, ::-1] + facts["rest"][:, None]
    parents = None
    for j, runs, real, edge in shard.nodes():
        depth, members = shard.depth(j, runs), np.diff(np.r_[runs, len(shard.conv)])
        at = shard.block * shard.width + j
        own = real & (j > 0) | (shard.block[runs] == 0) & (j == 0)
        goes_on = np.logical_or.reduceat(facts["n"] > at, runs)
        # Roots of later blocks are nodes of the block before; here they only ask who their rep is.
        asks = (j == 0) & (shard.block[runs] > 0)
        shared = edge | asks | (j == shard.width) & goes_on
        rep = np.minimum.reduceat(shard.conv, runs)
        ended = (facts["n"] == at) & (shard.lengths >= j)
        ends = np.add.reduceat(ended.astype(np.int64), runs)
        child = (facts["f"] <= at + 1) & (at + 1 <= facts["n"])
        sums = {
            "n_convs": members,
            "n_children": np.add.reduceat(child.astype(np.int64), runs),
            "n_leaves": np.add.reduceat(facts["leaf"], runs),
            "saved": np.add.reduceat(below[:, j], runs),
        }
        kept = np.flatnonzero(own | asks)
        sha: list[str | None] = [NO_ENDS] * len(kept)
        chunks: list[tuple[int, np.ndarray]] = []
        for i, r in enumerate(kept):
            if shared[r]:
                sha[i] = None
            if own[r] and ends[r]:
                ids = shard.conv[runs[r] : runs[r] + members[r]]
                ids = np.sort(ids[ended[runs[r] : runs[r] + members[r]]])
                if shared[r]:
                    chunks += [(r, ids[k : k + CHUNK_IDS]) for k in range(0, len(ids), CHUNK_IDS)]
                else:
                    sha[i] = _digest(ids)
        names = {"k1": shard.names[0][runs, j], "k2": shard.names[1][runs, j]}
        above: dict = {}
        if j > 0:
            known, who = parents
            parent = [int(w) if k else None for k, w in zip(known[runs[kept]], who[runs[kept]], strict=True)]
            above = {"parent": pa.array(parent, pa.int64()), "p1": shard.names[0][runs, j - 1][kept], "p2": shard.names[1][runs, j - 1][kept]}
        yield _batch(
            SUMMED,
            shard=number,
            open=shared[kept],
            depth=depth[kept],
            sha=pa.array(sha, pa.string()),
            rep=pa.array(rep[kept], mask=asks[kept]),
            **{k: v[kept] for k, v in names.items()},
            **{k: np.where(asks, 0, v)[kept] for k, v in sums.items()},
            **above,
        )
        if chunks:
            where = np.array([r for r, _ in chunks])
            yield _batch(
                SUMMED,
                shard=number,
                open=True,
                depth=depth[where],
                rep=np.array([ids[0] for _, ids in chunks]),
                ids=pa.array([ids.tolist() for _, ids in chunks], pa.list_(pa.int64())),
                **{k: v[where] for k, v in names.items()},
            )
        parents = np.repeat(~shared, members), np.repeat(rep, members)


def _hashed(chunks: DataFrame) -> DataFrame:
    """(depth, k1, k2, sha): ids of each node's chunks in their order, through one running hash."""
    key = ["depth", "k1", "k2"]
    types = "depth bigint, k1 bigint, k2 bigint, sha string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest, out = None, hashlib.sha256(), []
        schema = _arrow(types)

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in out], schema=schema)

        for batch in batches:
            names = zip(*(column(batch, c).to_pylist() for c in key), strict=True)
            for name, ids in zip(names, column(batch, "ids"), strict=True):
                text = ",".join(map(str, ids.values.to_pylist()))
                if name == now:
                    digest.update(b"," + text.encode())
                    continue
                if now is not None:
                    out.append((*now, digest.hexdigest()))
                now, digest = name, hashlib.sha256(text.encode())
            yield rows()
            out = []
        if now is not None:
            out.append((*now, digest.hexdigest()))
            yield rows()

    dealt = chunks.select(*key, "rep", "ids").repartition(*key).sortWithinPartitions(*key, "rep")
    return dealt.mapInArrow(run, types)


def trie(
    conversations: DataFrame,
    rule: Callable[[Column], tuple[Column, Column]] = shared_turns,
    *,
    width: int = WIDTH,
    rows: int = SHARD_ROWS,
    head: int = HEAD,
) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256).

    One row per different sequence of first turns, the empty one included; ``rule`` gives the
    conversation whose first turns each one takes and how many (8 at most). Turns of equal number
    are ordered by role and the MD5 of their text, null numbers first; rows that repeat are turns of
    their own, null roles and texts are empty. Rows without conv_id belong to no conversation and
    are left out; other columns are ignored. An empty table has no node.

    A task holds ``rows`` blocks of ``width`` turns at a time, whatever the length or number of
    copies of a conversation. One task reads in a stream what can't be cut: the numbers of a
    conversation's blocks (a row per ``width`` turns), and for the hash of a node that spans shards
    the ids that end there.
    """
    blocks = staged(in_blocks(rebuilt(numbered(conversations), rule), width), "turn-blocks")
    key = ["depth", "k1", "k2"]
    counted = staged(_sharded(blocks, _count, COUNTED, width, rows, head), "trie-counts")
    facts = ["n_convs", "rep", "n_ends", "size"]
    met = (
        counted.where("open")
        .groupBy(*key)
        .agg(F.sum("n_convs").alias("n_convs"), F.min("rep").alias("rep"), F.sum("n_ends").alias("n_ends"), F.max("size").alias("size"))
    )
    nodes = counted.where(~F.col("open")).select(*key, *facts).unionByName(met)
    values = (
        nodes.withColumn("value", (F.col("n_convs") - 1) * F.col("size"))
        .groupBy(F.col("rep").alias("conv_id"), F.floor((F.col("depth") - 1) / width).alias("block"))
        .agg(
            F.sort_array(F.collect_list(F.struct("depth", "value"))).alias("own"),
            F.sum("value").alias("total"),
            F.min("depth").alias("f"),
            F.max((F.col("n_ends") == F.col("n_convs")).cast("bigint")).alias("leaf"),
        )
    )
    whole = Window.partitionBy("conv_id")
    later = whole.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    empty = F.array().cast("array<bigint>")
    valued = blocks.join(values, ["conv_id", "block"], "left").select(
        *(c for c in blocks.columns if c != "sizes"),
        F.coalesce(F.col("own.depth"), empty).alias("depths"),
        F.coalesce(F.col("own.value"), empty).alias("values"),
        F.coalesce(F.min("f").over(whole), F.col("n") + 1).alias("f"),
        F.coalesce(F.max("leaf").over(whole), F.lit(0)).alias("leaf"),
        F.coalesce(F.sum("total").over(later), F.lit(0)).alias("rest"),
    )
    summed = staged(_sharded(valued, _sum, SUMMED, width, rows, head), "trie-sums")

    sums = ["n_convs", "n_children", "n_leaves", "saved"]
    parts = summed.where(F.col("open") & F.col("ids").isNull())
    met = parts.groupBy(*key).agg(F.min("rep").alias("rep"), *(F.sum(c).alias(c) for c in sums), F.min("parent").alias("known"))
    met = staged(met.join(_hashed(summed.where(F.col("ids").isNotNull())), key, "left"), "trie-met")
    # Every shard learns the smallest member of the shared nodes it knows; no key holds more than a shard.
    reps = parts.select("shard", *key).distinct().join(met.select(*key, F.col("rep").alias("above")), key)
    reps = reps.select("shard", (F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), "above")
    closed = summed.where(~F.col("open"))
    one = parts.where(F.col("p1").isNotNull() & (F.col("n_convs") > 0)).groupBy(*key).agg(
        F.min(F.struct("shard", "p1", "p2", "parent")).alias("one")
    )
    shared = (
        met.join(one, key, "left")
        .select(*key, "rep", *sums, F.coalesce("sha", F.lit(NO_ENDS)).alias("sha"), "one.shard", "one.p1", "one.p2", "one.parent")
    )
    fields = ["shard", "depth", "p1", "p2", "parent", "rep", *sums, "sha"]
    both = closed.select(*fields).unionByName(shared.select(*fields))
    asking = both.where(F.col("parent").isNull() & F.col("p1").isNotNull()).join(reps, ["shard", "depth", "p1", "p2"], "left")
    done = both.where(F.col("parent").isNotNull() | F.col("p1").isNull()).withColumn("above", F.col("parent"))
    return asking.select(*fields, "above").unionByName(done.select(*fields, "above")).select(
        F.col("rep").alias("conv_id"),
        "depth",
        F.col("above").alias("parent_conv_id"),
        "n_convs",
        "n_children",
        F.when(F.col("n_children") == 0, 1).otherwise(F.col("n_leaves")).cast("bigint").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        F.col("sha").alias("ends_sha256"),
    )
