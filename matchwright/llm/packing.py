"""Best-fit packing of documents into sequences of several permitted lengths.

Pieces are placed longest first into the open bin that they fill best. A piece that fits no open
bin opens the size that is cheapest per token if the pieces still to come fill it up. Packings that
open only one size where it holds the piece are made beside it, and the cheapest in total is taken.
At the end every bin takes the cheapest size that still holds its contents.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import staged

CAPACITIES = (512, 1024, 2048, 4096)
SHARD_ROWS = 20_000


def sequence_cost(capacity: int) -> float:
    """Cost of one sequence: a fixed share, one unit per token, attention by the square."""
    return 64.0 + capacity + capacity**2 / 32768.0


def _filled(lengths: np.ndarray, at_most: list[int], i: int, capacity: int) -> int:
    """Tokens in a bin of this size that piece i opens and the pieces after it fill, longest first."""
    room, j, n = capacity - int(lengths[i]), i + 1, len(lengths)
    while room:
        j = max(j, at_most[room])
        if j == n:
            break
        size = int(lengths[j])
        # All pieces of this length that fit, up to the first shorter one.
        taken = min(room // size, at_most[size - 1] - j)
        room, j = room - taken * size, at_most[size - 1]
    return capacity - room


def place(
    lengths: np.ndarray, capacities: tuple[int, ...], cost: Callable[[int], float], opening: int | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As ``best_fit``, by one rule: the size cheapest by what is still to come, or ``opening``.

    ``opening`` is the size of every new bin whose first piece fits it; longer ones open the least
    size that holds them.
    """
    sizes_up = sorted(set(capacities))
    by_size = sorted(sizes_up, key=lambda c: (cost(c), c))
    # at_most[r]: the first piece of at most r tokens.
    at_most = np.searchsorted(-lengths, -np.arange(sizes_up[-1] + 1), "left").tolist()

    def opened(i: int, length: int) -> int:
        fitting = [c for c in sizes_up if c >= length]
        if opening is not None:
            return opening if opening >= length else fitting[0]

        def per_token(size: int) -> tuple[float, int]:
            used = _filled(lengths, at_most, i, size)
            return min(cost(c) for c in sizes_up if c >= used) / used, -size

        return min(fitting, key=per_token)

    rooms: list[tuple[int, int]] = []  # (room, bin), sorted
    used: list[int] = []
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    for i, length in enumerate(lengths.tolist()):
        at = bisect_left(rooms, (length, -1))
        if at < len(rooms):
            room, own = rooms.pop(at)
        else:
            own, room = len(used), opened(i, length)
            used.append(0)
        bins[i], offsets[i] = own, used[own]
        used[own] += length
        if room > length:
            insort(rooms, (room - length, own))
    final = np.array([next(c for c in by_size if c >= u) for u in used], np.int64)
    return bins, offsets, final


def best_fit(
    lengths: np.ndarray, capacities: tuple[int, ...] = CAPACITIES, cost: Callable[[int], float] = sequence_cost
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bin, offset in the bin) of every piece, and the final size of every bin.

    Pieces must be sorted from long to short, at least 1 and at most the largest capacity long. Of
    bins with equal room the one opened first is taken, of sizes with equal cost per token the
    larger one. Of all rules the cheapest packing is taken, of equal ones that by what is to come.
    """
    packings = [place(lengths, capacities, cost, opening) for opening in (None, *sorted(set(capacities)))]
    return min(packings, key=lambda x: sum(map(cost, x[2].tolist())))


def words(text: Column) -> Column:
    """Number of words of a text; 0 for null and blank ones."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def pieces(rows: DataFrame, largest: int) -> DataFrame:
    """(doc_id, total, copy, piece, start, length) of (doc_id, total, copies): pieces of at most ``largest``."""
    cut = rows.withColumn("copy", F.explode(F.expr("sequence(1, copies)"))).withColumn(
        "piece", F.explode(F.expr(f"sequence(0, cast((total - 1) div {largest} as int))"))
    )
    start = F.col("piece").cast("bigint") * largest
    length = F.least(F.lit(largest), F.col("total") - start)
    return cut.select("doc_id", "total", "copy", "piece", start.alias("start"), length.alias("length"))


def pack(
    docs: DataFrame,
    capacities: tuple[int, ...] = CAPACITIES,
    cost: Callable[[int], float] = sequence_cost,
    length: Column | None = None,
    doc_id: str = "doc_id",
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """(bin_id, capacity, used, doc_id, piece, start, length, offset): one row per piece.

    ``length`` counts the tokens of a document (default: words of ``text``). Longer documents than
    the largest capacity become several pieces that together hold all of it; ``start`` counts from
    the document's first token, ``offset`` from the bin's. Documents without tokens (null or blank
    text) go into no bin. Repeated rows and null ids are packed like any other; other columns are
    ignored.

    The pieces are dealt at random but repeatably into shards of about ``shard_rows`` pieces, and
    each shard is packed on its own: every shard has room for the next of its pieces in some open
    bin but for its last few, so the loss against one run over all pieces is below one bin of each
    size per shard. Pieces are named by id and lengths, so the bins don't depend on how the input
    is partitioned; rows that repeat both are counted before they move. The shuffles carry ids and
    lengths only, and no shard grows with the data.
    """
    if not capacities or min(capacities) < 1:
        raise ValueError("capacities must be positive")
    largest = max(capacities)
    total = words(F.col("text")) if length is None else length
    sized = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), total.cast("bigint").alias("total"))
    rows = sized.where("total > 0").groupBy("doc_id", "total").agg(F.count("*").alias("copies"))
    rows = staged(rows, "packing-rows")
    n = rows.agg(F.sum(F.expr(f"copies * ((total - 1) div {largest} + 1)"))).first()[0] or 0
    shards = max(1, -(-n // shard_rows))
    named = F.xxhash64("doc_id", "total", "copy", "piece")
    dealt = pieces(rows, largest).withColumn("shard", F.pmod(named, F.lit(shards)))

    def run(shard: pd.DataFrame) -> pd.DataFrame:
        ordered = shard.sort_values(
            ["length", "doc_id", "piece", "total", "copy"],
            ascending=[False, True, True, True, True],
            na_position="first",
        )
        bins, offsets, sizes = best_fit(ordered["length"].to_numpy(), capacities, cost)
        used = np.bincount(bins, ordered["length"].to_numpy(), minlength=len(sizes)).astype(np.int64)
        return pd.DataFrame(
            {
                "bin_id": bins + int(ordered["shard"].iloc[0]) * (1 << 32),
                "capacity": sizes[bins],
                "used": used[bins],
                "doc_id": ordered["doc_id"].astype("Int64"),
                "piece": ordered["piece"],
                "start": ordered["start"],
                "length": ordered["length"],
                "offset": offsets,
            }
        )

    return dealt.groupBy("shard").applyInPandas(
        run,
        "bin_id bigint, capacity bigint, used bigint, doc_id bigint, piece int, start bigint, length bigint, offset bigint",
    )
