"""Writes that can be repeated and that never destroy what is being read."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import stage
from .files import read_table


def overwrite_partitions(
    df: DataFrame,
    path: str,
    by: list[str],
    *,
    sort: list[str] | None = None,
    fmt: str = "parquet",
    file_rows: int = 0,
) -> None:
    """Replace the partitions present in ``df``; all others stay. Running it twice is harmless.

    Rows are rebalanced by partition, so that adaptive execution splits a very large season over
    many tasks and joins small ones; ``sort`` orders the rows inside each file, and a file has at
    most ``file_rows`` of them (0: any number).
    """
    out = df.hint("rebalance", *[F.col(c) for c in by])
    if sort:
        out = out.sortWithinPartitions(*by, *[c for c in sort if c in df.columns])
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option(
        "header", True
    ).option("maxRecordsPerFile", file_rows).partitionBy(*by).format(fmt).save(path)


# What Spark escapes in the folder of a partition value, and the folder of no value.
_ESCAPED = re.compile(r"""[\x00-\x1f\x7f"#%'*/:=?\\{\[\]^]""")
_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def partition_folder(by: list[str], values: tuple) -> str:
    """The folder of a partition, with escapes as Spark writes them."""

    def shown(value) -> str:
        text = "" if value is None else str(value)
        return _ESCAPED.sub(lambda m: f"%{ord(m[0]):02X}", text) if text else _NO_VALUE

    return "/".join(f"{shown(c)}={shown(v)}" for c, v in zip(by, values, strict=True))


def clear_partitions(
    spark: SparkSession, path: str, by: list[str], emptied: Iterable[tuple]
) -> None:
    """Remove whole partitions, named by their values in the order of ``by``."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    for values in emptied:
        target = hadoop.Path(f"{path.rstrip('/')}/{partition_folder(by, values)}")
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def replace_partitions(
    df: DataFrame,
    path: str,
    by: list[str],
    due: Iterable[tuple],
    *,
    sort: list[str] | None = None,
    fmt: str = "parquet",
    staged: bool = False,
    file_rows: int = 0,
) -> None:
    """Make the partitions named in ``due`` hold exactly the rows of ``df``.

    Partitions of ``due`` without a row now are removed, so nothing stale is left behind; all
    others stay. Full partitions are replaced before empty ones are removed, and a run that ends in
    between is mended by the next. One writer per partition at a time. The rows are computed once:
    they are staged, and the staged copy tells which partitions are filled. ``staged`` says that
    ``df`` reads such a copy already, none of it from ``path``.
    """
    rows = df if staged else stage(df, "replacement")
    overwrite_partitions(rows, path, by, sort=sort, fmt=fmt, file_rows=file_rows)
    filled = {partition_folder(by, tuple(r)) for r in rows.select(*by).distinct().collect()}
    emptied = [x for x in due if partition_folder(by, tuple(x)) not in filled]
    clear_partitions(df.sparkSession, path, by, emptied)


def store(df: DataFrame, path: str, by: list[str], *, sort: list[str] | None = None) -> DataFrame:
    """Overwrite the touched partitions of a keyed table by rows that may be computed from it.

    The rows are staged in the shared folder first, so the table is never read while it is being
    replaced. Returns the staged rows.
    """
    rows = stage(df, "stage")
    overwrite_partitions(rows, path, by, sort=sort)
    return rows


def touched(existing: DataFrame, incoming: DataFrame, by: list[str]) -> DataFrame:
    """The stored rows of the partitions that incoming rows touch."""
    return existing.join(incoming.select(*by).distinct(), by, "left_semi")


def current(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A stored table; an empty one before the first write."""
    order = spark.createDataFrame([], schema).columns
    return read_table(spark, path, schema).select(*order)
