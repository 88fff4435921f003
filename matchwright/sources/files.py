"""CSV files whose headers drift, and tables that may not exist yet."""

from __future__ import annotations

import csv
from collections.abc import Iterable, Mapping
from urllib.parse import unquote

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..session import stage


RAGGED = "_ragged"
# A quoted field, from the start of the line or a comma on; a backslash escapes a quote.
_QUOTED = r'(?<=^|,)"(?:[^"\\]|\\.)*"'


def file_table(spark: SparkSession, columns: Mapping[str, tuple[pa.DataType, list]]) -> DataFrame:
    """A small table about files, one row each: its size is known, so Spark sees what it may broadcast.

    Lines that met a table of unknown size would be shuffled by their file, all lines of one to one task.
    """
    return spark.createDataFrame(pa.table({name: pa.array(values, kind) for name, (kind, values) in columns.items()}))


def headers_of(spark: SparkSession, paths: Iterable[str]) -> dict[str, tuple[str, ...]]:
    """Header of every file below ``paths`` (files, or folders of parts), read by one job.

    Only the first line of each file reaches the driver. Empty files have no entry.
    """
    lines = spark.read.text(list(paths)).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("at"),
    )
    first = lines.where("start = 0").groupBy("file").agg(F.min_by("value", "at").alias("header"))
    return {
        r["file"]: tuple(next(csv.reader([r["header"]]))) for r in first.collect() if r["header"].strip()
    }


def read_text_csv(
    spark: SparkSession,
    paths: Iterable[str],
    headers: Mapping[str, tuple[str, ...]] | None = None,
) -> DataFrame:
    """Files with drifting headers as one frame of text columns, with ``_file`` for the origin.

    One scan of lines, however many files and headers there are. A small table says which header a
    file has; the fields of a line are parsed once, and each column takes the field at the place
    that the line's header gives it, or null. The plan has one expression per column name.

    Lines with more or fewer fields than the header are kept whole in the column ``_ragged``, null
    for all others; see ``ragged_lines`` and ``reject_ragged``. Blank lines and lines that repeat
    the header are no records. ``headers`` is what ``headers_of`` found, if that is known already.
    """
    known = dict(sorted((headers_of(spark, paths) if headers is None else headers).items()))
    if not known:
        raise ValueError("no files to read")
    kinds = list(dict.fromkeys(known.values()))
    names = list(dict.fromkeys(c for header in kinds for c in header))
    width = max(map(len, kinds))
    places = [[header.index(c) if c in header else -1 for c in names] for header in kinds]
    number = {header: i for i, header in enumerate(kinds)}
    of_file = file_table(
        spark,
        {
            "_file": (pa.string(), list(known)),
            "_kind": (pa.int32(), [number[header] for header in known.values()]),
            "_width": (pa.int32(), [len(header) for header in known.values()]),
        },
    )
    lines = spark.read.text([unquote(file) for file in known]).select(
        "value", F.col("_metadata.file_path").alias("_file")
    )
    schema = StructType([StructField(f"f{i}", StringType()) for i in range(width)])
    parsed = F.from_csv("value", schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "))
    bare = F.when(F.contains("value", F.lit('"')), F.regexp_replace("value", _QUOTED, "")).otherwise(F.col("value"))
    fields = 1 + F.length(bare) - F.length(F.replace(bare, F.lit(",")))
    # The fields leave generators, so that neither filters nor columns parse the line again.
    split = (
        lines.where(F.trim("value") != "")
        .join(of_file, "_file")
        .select("value", "_file", "_kind", "_width", F.explode(F.array(F.struct(parsed.alias("f"), fields.alias("n")))).alias("_l"))
        .select(
            "value", "_file", "_kind", "_width", F.col("_l.n").alias("_n"),
            F.explode(F.array(F.array(*[F.col(f"_l.f.f{i}") for i in range(width)]))).alias("_f"),
        )
    )
    heads = F.array(*[F.array(*[F.lit(c) for c in header]) for header in kinds])
    own = F.slice(F.col("_f"), 1, F.col("_width"))
    begins = F.get("_f", F.lit(0)).eqNullSafe(F.element_at(F.array(*[F.lit(header[0]) for header in kinds]), F.col("_kind") + 1))
    is_header = begins & (F.col("_n") == F.col("_width")) & (own == F.element_at(heads, F.col("_kind") + 1))
    at = F.element_at(F.array(*[F.array(*[F.lit(x) for x in row]) for row in places]), F.col("_kind") + 1)
    routed = split.where(~F.coalesce(is_header, F.lit(False))).withColumn("_at", at)
    return routed.select(
        *[F.get("_f", F.col("_at")[j]).alias(c) for j, c in enumerate(names)],
        F.when(F.col("_n") != F.col("_width"), F.col("value")).alias(RAGGED),
        "_file",
    )


def ragged_lines(df: DataFrame) -> DataFrame:
    """Number of ragged lines per file.

    The lines themselves are staged first, as Spark can't count them in a scan that needs no field.
    """
    found = stage(df.where(F.col(RAGGED).isNotNull()), "ragged")
    return found.groupBy("_file").agg(F.count("*").alias("lines"))


def reject_ragged(df: DataFrame) -> DataFrame:
    """The same rows without the column; the first ragged line ends the job with its text."""
    told = F.concat(F.lit("ragged line in "), "_file", F.lit(": "), RAGGED)
    sound = F.when(F.col(RAGGED).isNull(), True).otherwise(F.raise_error(told).cast("boolean"))
    return df.where(sound).drop(RAGGED)


def read_table(spark: SparkSession, path: str, schema: str, fmt: str = "parquet") -> DataFrame:
    """A typed table; an empty one with the same columns where nothing was written yet."""
    try:
        reader = spark.read.schema(schema)
        if fmt == "csv":
            reader = reader.option("header", True).option("enforceSchema", False)
        return reader.format(fmt).load(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_tables(
    spark: SparkSession, folder: str, names: Iterable[str]
) -> Mapping[str, DataFrame]:
    """Parquet tables of one folder by name."""
    return {n: spark.read.parquet(f"{folder.rstrip('/')}/{n}.parquet") for n in names}


def seasons_on_file(df: DataFrame, by: tuple[str, ...] = ("tour", "year")) -> DataFrame:
    """Which partitions exist; Spark answers from the partition folders."""
    return df.select(*by).distinct().orderBy(*by)
