"""Helpers shared by the corpus operators: reading tables, fields of a hash, staging, word hashes."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir

CHUNK = 1 << 20


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """A table of the data folder, by Spark's reader only."""
    return spark.read.parquet(f"{folder.rstrip('/')}/{table}.parquet")


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null ids go to fold -1."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds, F.lit(-1))


def staged(df: DataFrame, name: str) -> DataFrame:
    """The frame written once as Parquet in the shared folder and read back.

    Cuts the lineage, is computed once for several readers and outlives lost executors.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def texts(batch: pa.RecordBatch, name: str = "text") -> Iterator[str | None]:
    """One text at a time, so that a batch isn't held twice as Python strings."""
    return (value.as_py() for value in column(batch, name))


def slices(batches: Iterable[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Smaller batches, so that what a worker holds follows a few documents, not 10,000."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


@lru_cache(maxsize=1)
def _powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base modulo 2**64 and their inverses, one per byte of a chunk."""
    base = 0x9E3779B97F4A7C15
    inverse = pow(base, -1, 1 << 64)

    def run(step: int) -> np.ndarray:
        out = np.full(CHUNK + 1, step, dtype=np.uint64)
        out[0] = 1
        with np.errstate(over="ignore"):
            return np.multiply.accumulate(out)

    return run(base), run(inverse)


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over all 64 output bits."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def chunks(data: bytes) -> Iterator[bytes]:
    """Pieces of at most CHUNK bytes, cut at a space where there is one."""
    start = 0
    while len(data) - start > CHUNK:
        end = data.rfind(b" ", start + 1, start + CHUNK)
        end = start + CHUNK if end < 0 else end
        yield data[start:end]
        start = end
    yield data[start:]


def word_spans(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of bytes that are not ASCII white space."""
    inside = np.zeros(len(raw) + 2, dtype=np.int8)
    inside[1:-1] = ~_SPACE[raw]
    turns = np.diff(inside)
    return np.flatnonzero(turns == 1), np.flatnonzero(turns == -1)


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans of one chunk, all at once by prefix sums.

    The prefix sum of byte * base**i gives every span by one subtraction; the power of the start
    is then divided out. Equal words have equal hashes wherever they stand.
    """
    power, inverse = _powers()
    with np.errstate(over="ignore"):
        sums = np.zeros(len(raw) + 1, dtype=np.uint64)
        np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * power[: len(raw)], out=sums[1:])
        return mix((sums[ends] - sums[starts]) * inverse[starts])
