"""Ranked lexical search by Block-Max MaxScore over shards of an inverted index.

Tasks turn their documents into shards: sorted lists of compressed blocks for every term, with the
largest count and the shortest document of every block beside it. A query divides its lists by their
global bounds. Essential lists bring candidates; on all others the block maxima reject candidates
before a block is unpacked. Each shard keeps its best documents, and the shards' heaps are merged.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import column, slices, staged, texts

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BYTES = bytes(
    (b if chr(b).isalnum() else 0x20) if b < 0x80 else b for b in range(256)
).translate(bytes.maketrans(_UPPER.encode(), _LOWER.encode()))

SHARD_DOCS, SHARD_POSTINGS, BLOCK, SPAN = 16_384, 4_000_000, 128, 4_096
# A vocabulary of queries up to this many terms and bytes limits the index; else all terms are kept.
KNOWN_TERMS, KNOWN_BYTES = 1_000_000, 32 << 20
ITEMS, SHARDS = 256, 4
PIECE = 1 << 20
INDEX = (
    "shard bigint, term string, df bigint, docs array<bigint>, lengths array<bigint>, last array<bigint>, "
    "top_tf array<bigint>, least array<bigint>, blocks array<binary>"
)
_KINDS = {"bigint": pa.int64(), "string": pa.string(), "array<bigint>": pa.list_(pa.int64()), "array<binary>": pa.list_(pa.binary())}
_SCHEMA = pa.schema([(n, _KINDS[k]) for n, k in (f.rsplit(" ", 1) for f in INDEX.split(", "))])


def terms_of(text: Column) -> Column:
    """Different terms of a text, as the index reads them; none of a null."""
    found = F.regexp_extract_all(F.translate(text, _UPPER, _LOWER), F.lit(TERM), 0)
    return F.coalesce(F.array_distinct(found), F.array().cast("array<string>"))


def counts(text: str | None) -> Counter[bytes]:
    """Terms of a text with their occurrences. Long texts are read in pieces that end at a separator."""
    out: Counter[bytes] = Counter()
    data = (text or "").encode().translate(_BYTES)
    start = 0
    while start < len(data):
        end = data.find(b" ", start + PIECE)
        end = len(data) if end < 0 else end
        out.update(data[start:end].split())
        start = end
    return out


def pack(ordinals: np.ndarray, tfs: np.ndarray) -> bytes:
    """A block: widths of steps and counts, the first document, steps to the next ones, counts."""
    steps = np.diff(ordinals)
    widths = [next(w for w in (1, 2, 4, 8) if v.max(initial=0) < 1 << (8 * w - 1)) for v in (steps, tfs)]
    return (
        bytes(widths)
        + int(ordinals[0]).to_bytes(4, "little")
        + steps.astype(f"<u{widths[0]}").tobytes()
        + tfs.astype(f"<u{widths[1]}").tobytes()
    )


def unpack(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = (len(data) - 6 + data[0]) // (data[0] + data[1])
    steps = np.frombuffer(data, f"<u{data[0]}", n - 1, 6)
    out = np.empty(n, np.int64)
    out[0] = int.from_bytes(data[2:6], "little")
    np.cumsum(steps, out=out[1:], dtype=np.int64)
    out[1:] += out[0]
    return out, np.frombuffer(data, f"<u{data[1]}", n, 6 + (n - 1) * data[0]).astype(np.int64)


class Builder:
    """A shard being filled."""

    def __init__(self, block: int) -> None:
        self.block, self.numbers, self.postings = block, {}, 0
        self.docs: list[int | None] = []
        self.lengths: list[int] = []
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, doc_id: int | None, found: Counter[bytes], known: frozenset[bytes] | None) -> None:
        own = found.keys() if known is None else found.keys() & known
        terms = np.fromiter((self.numbers.setdefault(t, len(self.numbers)) for t in own), np.int64, len(own))
        self.parts.append((terms, np.fromiter((found[t] for t in own), np.int64, len(own))))
        self.docs.append(doc_id)
        self.lengths.append(found.total())
        self.postings += len(own)

    def rows(self, shard: int) -> Iterator[pa.RecordBatch]:
        """A row of the documents, short ones first, and a row per term.

        Documents without an id count in df, but no list leads to them.
        """
        named = np.array([d is not None for d in self.docs], dtype=bool)
        ids = np.array([d or 0 for d in self.docs], dtype=np.int64)
        lengths = np.array(self.lengths, dtype=np.int64)
        order = np.lexsort((ids, lengths, ~named))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        sizes = [len(t) for t, _ in self.parts]
        terms = np.concatenate([t for t, _ in self.parts])
        tfs = np.concatenate([c for _, c in self.parts])
        docs = np.repeat(place, sizes)
        by = np.lexsort((docs, terms))
        terms, tfs, docs = terms[by], tfs[by], docs[by]
        ends = np.cumsum(np.bincount(terms, minlength=len(self.numbers)))
        n_named, lengths = int(named.sum()), lengths[order]
        out = [{"shard": shard, "docs": ids[order][:n_named], "lengths": lengths}]
        for term, number in self.numbers.items():
            start, end = int(ends[number - 1]) if number else 0, int(ends[number])
            stop = start + int(np.searchsorted(docs[start:end], n_named))
            cuts = [(k, min(k + self.block, stop)) for k in range(start, stop, self.block)]
            out.append(
                {
                    "shard": shard,
                    "term": term.decode(),
                    "df": end - start,
                    "last": [int(docs[b - 1]) for _, b in cuts],
                    "top_tf": [int(tfs[a:b].max()) for a, b in cuts],
                    "least": [int(lengths[docs[a]]) for a, _ in cuts],
                    "blocks": [pack(docs[a:b], tfs[a:b]) for a, b in cuts],
                }
            )
            if len(out) == 4096:
                yield pa.RecordBatch.from_pylist(out, schema=_SCHEMA)
                out = []
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=_SCHEMA)


def index(docs: DataFrame, terms: DataFrame | None = None, *, shard_docs: int = SHARD_DOCS, block: int = BLOCK) -> DataFrame:
    """The inverted index, a row per (shard, term) and one per shard for its documents.

    Every row of ``docs`` (doc_id, text) is a document, repeated ids too. A shard has at most
    ``shard_docs`` documents and about SHARD_POSTINGS postings of one task; nothing is shuffled.
    With ``terms``, a frame (term) of those that queries will use, lists of other terms are left
    out, if these terms are few enough to be sent to the tasks (KNOWN_TERMS, KNOWN_BYTES).
    """
    known = None
    if terms is not None:
        terms = terms.select("term").distinct()
        size = terms.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("term")), F.lit(0))).first()
        if size[0] <= KNOWN_TERMS and size[1] <= KNOWN_BYTES:
            known = frozenset(r[0].encode() for r in terms.collect())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, builder = TaskContext.get().partitionId() << 32, Builder(block)
        for batch in slices(batches, 256):
            for doc_id, text in zip(column(batch, "doc_id").to_pylist(), texts(batch), strict=True):
                builder.add(doc_id, counts(text), known)
                if len(builder.docs) == shard_docs or builder.postings >= SHARD_POSTINGS:
                    yield from builder.rows(number)
                    number, builder = number + 1, Builder(block)
        if builder.docs:
            yield from builder.rows(number)

    own = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text"))
    return staged(own.mapInArrow(run, INDEX), "lexical-index")


class Corpus:
    """The two sums over all documents that every score needs."""

    def __init__(self, n: int, total: int) -> None:
        self.n, self.total = n, total

    def norms(self, lengths: np.ndarray) -> np.ndarray:
        if 90 * int(lengths.max(initial=0)) * self.n >= 1 << 63:
            lengths = lengths.astype(object)
        return (10 + 90 * lengths * self.n // max(1, self.total)).astype(np.int64)


def impact(tf: np.ndarray, norm: np.ndarray) -> np.ndarray:
    """A term's part of a score without its weight; grows with tf and falls with the length."""
    return 1_000_000_000 * tf // (1000 * tf + 8 * norm)


class List:
    """One term's blocks in a shard. Blocks are unpacked when a query first needs them."""

    def __init__(self, last: np.ndarray, top_tf: np.ndarray, least: np.ndarray, blocks: list, norms: np.ndarray, corpus: Corpus) -> None:
        self.last, self.blocks, self.norms = last, blocks, norms
        self.bounds = impact(top_tf, corpus.norms(least))
        self.bound = int(self.bounds.max(initial=0))
        self.open: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def read(self, numbers: np.ndarray | range) -> tuple[np.ndarray, np.ndarray]:
        """Documents and impacts of some blocks, in order."""
        for b in numbers:
            if b not in self.open:
                docs, tfs = unpack(self.blocks[b])
                self.open[b] = docs, impact(tfs, self.norms[docs])
        parts = [self.open[b] for b in numbers]
        if len(parts) == 1:
            return parts[0]
        return tuple(np.concatenate(x) for x in zip(*parts, strict=True)) if parts else (np.zeros(0, np.int64),) * 2

    def between(self, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents from low to below high."""
        first, end = np.searchsorted(self.last, (low, high), "left")
        docs, impacts = self.read(range(first, min(end + 1, len(self.last))))
        a, b = np.searchsorted(docs, (low, high), "left")
        return docs[a:b], impacts[a:b]


def best(lists: list[tuple[int, List]], docs: np.ndarray, k: int, span: int = SPAN) -> tuple[np.ndarray, np.ndarray]:
    """Ids and scores of the k best documents of a shard; equal scores by id.

    ``lists`` are (weight, list). Documents are taken in spans. With the k-th score so far as
    threshold, the lists of least bound that can't reach it together are not essential: a document
    that stands in them only is not looked at. A document that could tie with the threshold is kept,
    as its id may be smaller.
    """
    lists = sorted((x for x in lists if x[0] > 0 and x[1].bound > 0), key=lambda x: x[0] * x[1].bound)
    reach = np.cumsum([0] + [w * x.bound for w, x in lists], dtype=np.int64)
    ids, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for low in range(0, len(docs), span):
        least = int(scores[-1]) if len(scores) == k else 1
        first = int(np.searchsorted(reach[1:], least, "left"))
        if first == len(lists):
            break
        high = min(low + span, len(docs))
        total = np.zeros(high - low, np.int64)
        for weight, own in lists[first:]:
            held, impacts = own.between(low, high)
            total[held - low] += weight * impacts
        found = np.flatnonzero(total)
        found = found[total[found] + reach[first] >= least]
        for i in range(first - 1, -1, -1):
            weight, own = lists[i]
            at = np.searchsorted(own.last, found + low, "left")
            inside = at < len(own.last)
            bound = np.where(inside, own.bounds[np.minimum(at, len(own.last) - 1)], 0)
            kept = total[found] + weight * bound + reach[i] >= least
            found, at = found[kept], at[kept & inside]
            held, impacts = own.read(np.unique(at).tolist())
            if len(held):
                spot = np.minimum(np.searchsorted(held, found + low), len(held) - 1)
                total[found] += np.where(held[spot] == found + low, weight * impacts[spot], 0)
        found = found[total[found] >= least]
        ids, scores = np.r_[ids, docs[found + low]], np.r_[scores, total[found]]
        order = np.lexsort((ids, -scores))[:k]
        ids, scores = ids[order], scores[order]
    return ids, scores


def _lists(rows: dict, norms: np.ndarray, corpus: Corpus, numbers: list[int]) -> dict[str, List]:
    array = lambda name, i: np.array(rows[name][i].values, dtype=np.int64)
    return {
        rows["term"][i].as_py(): List(array("last", i), array("top_tf", i), array("least", i), rows["blocks"][i].as_py(), norms, corpus)
        for i in numbers
    }


def search(lists: DataFrame, items: DataFrame, k: int = 10, *, span: int = SPAN, block_items: int = ITEMS) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of an index for every item.

    ``items`` has item_id and term, one row per term (``item_terms``). Scores are integers above 0,
    ranks count from 1, equal scores are ordered by doc_id; fewer documents are all returned. Rows
    of ``docs`` that repeat a doc_id are documents of their own; those without one count in all
    statistics and are never returned. Items are taken in blocks; a task holds a few shards' lists
    of the terms of one block.
    """
    heads = lists.where(F.col("term").isNull())
    full = F.filter("lengths", lambda x: x > 0)
    row = heads.agg(
        F.coalesce(F.sum(F.size(full)), F.lit(0)),
        F.coalesce(F.sum(F.aggregate(full, F.lit(0).cast("bigint"), lambda a, x: a + x)), F.lit(0)),
        F.count(F.lit(1)),
    ).first()
    corpus, n_groups = Corpus(row[0], row[1]), max(1, math.ceil(row[2] / SHARDS))
    df = lists.where(F.col("term").isNotNull()).groupBy("term").agg(F.sum("df").alias("df"))
    weight = F.floor(1000 * F.log(F.lit(2.0 * corpus.n + 2) / (2 * F.col("df") + 1))).cast("bigint")
    weighted = items.select("item_id", "term").distinct().join(df, "term").select("item_id", "term", weight.alias("weight"))
    n_blocks = max(1, math.ceil(items.select(F.count_distinct("item_id")).first()[0] / block_items))
    of_block = F.pmod(F.xxhash64("item_id"), F.lit(n_blocks)).cast("int")
    of_group = F.pmod(F.xxhash64("shard"), F.lit(n_groups)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    # A list goes to the blocks of items that have its term, a block of items to every group of shards.
    wanted = weighted.select("term", of_block.alias("items")).distinct()
    own = (
        lists.join(wanted, "term")
        .select(*lists.columns, "items")
        .unionByName(heads.withColumn("items", each(n_blocks)))
        .withColumn("group", of_group)
    )
    asked = (
        weighted.groupBy("item_id")
        .agg(F.collect_list("term").alias("terms"), F.collect_list("weight").alias("weights"))
        .withColumn("items", of_block)
        .withColumn("group", each(n_groups))
    )
    schema = pa.schema([("item_id", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])

    def run(index_rows: pa.Table, item_rows: pa.Table) -> pa.Table:
        rows = {c: index_rows.column(c) for c in ("term", "docs", "lengths", "last", "top_tf", "least", "blocks")}
        by_shard: dict[int, list[int]] = {}
        for i, shard in enumerate(index_rows.column("shard").to_pylist()):
            by_shard.setdefault(shard, []).append(i)
        heads_at = {index_rows.column("shard")[i].as_py(): i for i, t in enumerate(rows["term"].to_pylist()) if t is None}
        out: list[tuple[list, np.ndarray, np.ndarray]] = []
        queries = item_rows.select(["item_id", "terms", "weights"]).to_pylist()
        for shard, numbers in by_shard.items():
            head = heads_at[shard]
            norms = corpus.norms(np.array(rows["lengths"][head].values, dtype=np.int64))
            docs = np.array(rows["docs"][head].values, dtype=np.int64)
            held = _lists(rows, norms, corpus, [i for i in numbers if i != head])
            for query in queries:
                chosen = [(w, held[t]) for t, w in zip(query["terms"], query["weights"], strict=True) if t in held]
                ids, scores = best(chosen, docs, k, span)
                out.append(([query["item_id"]] * len(ids), ids, scores))
        return pa.table(
            [
                pa.array([i for own_ids, _, _ in out for i in own_ids], pa.int64()),
                pa.array(np.concatenate([np.zeros(0, np.int64), *(x for _, x, _ in out)])),
                pa.array(np.concatenate([np.zeros(0, np.int64), *(x for _, _, x in out)])),
            ],
            schema=schema,
        )

    heaps = own.groupBy("group", "items").cogroup(asked.groupBy("group", "items")).applyInArrow(run, "item_id bigint, doc_id bigint, score bigint")
    place = Window.partitionBy("item_id").orderBy(F.desc("score"), "doc_id")
    return heaps.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, term): different terms of every item; rows of the same id (null too) are one item."""
    own = items.select(F.col("item_id").cast("bigint").alias("item_id"), F.explode(terms_of(F.col("text"))).alias("term"))
    return own.distinct()


def ranked(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """The k best documents for every item, over an index of the items' terms (see ``search``).

    An empty or null text has no term, so such a document is in no statistic and such an item gets
    no row; columns other than the id and the text are ignored.
    """
    terms = staged(item_terms(items), "item-terms")
    return search(index(docs, terms), terms, k)
