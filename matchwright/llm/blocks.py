"""Vectors in blocks: bounded groups of rows as one matrix each."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_ROWS = 2048


def usable(vector: Column) -> Column:
    """Neither null nor empty nor holding a null or non-finite component."""
    values = vector.cast("array<double>")
    bad = F.exists(values, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce((F.size(values) > 0) & ~bad, F.lit(False))


def n_blocks(rows: int, block_rows: int = BLOCK_ROWS) -> int:
    return max(1, -(-rows // block_rows))


def in_blocks(vectors: DataFrame, number: Column, *keys: str) -> DataFrame:
    """(keys, block, dim, ids, names, flat): rows with equal block number and dimension as one matrix.

    ``vectors`` has id, name, vector (array of numbers) and the key columns. A block number is shared by
    about BLOCK_ROWS rows, as the callers derive it from counts.
    """
    return (
        vectors.withColumn("block", number)
        .groupBy(*keys, "block", F.size("vector").alias("dim"))
        .agg(F.collect_list(F.struct("id", "name", "vector")).alias("rows"))
        .select(
            *keys,
            "block",
            "dim",
            F.col("rows.id").alias("ids"),
            F.col("rows.name").alias("names"),
            F.flatten(F.col("rows.vector")).alias("flat"),
        )
    )


def matrix(flat, dim: int, kind=np.float64) -> np.ndarray:
    return np.asarray(flat, dtype=kind).reshape(-1, dim)
