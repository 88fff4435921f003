"""Column profiles from sketches that are stored per season and merged for any set of seasons.

Counts are exact. Distinct values come from HyperLogLog sketches of 2**14 registers (standard error
0.8%), quantiles from KLL sketches (rank error about 1.3% with K = 200), frequent values from
frequent-item sketches that follow TRACKED values and are exact up to three quarters as many
different ones. The size of a sketch doesn't grow with the rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from ..sources.sinks import current, replace_partitions

LOG_REGISTERS = 14
TRACKED = 1024
FIELDS = (
    "column string, type string, rows bigint, present bigint, distinct_sketch binary, quantile_sketch binary, "
    "frequent_sketch struct<sketch:binary,maxItemsTracked:int,itemDataType:string,itemDataTypeDDL:string>"
)


def sketch(df: DataFrame, by: list[str], columns: list[str] | None = None) -> DataFrame:
    """(by, column, type, rows, present, three sketches): one pass over the rows.

    Values are told apart as text; only numeric columns have a quantile sketch. A column without a
    value has no sketches.
    """
    columns = columns or [c for c in df.columns if c not in by]
    measures = [F.count(F.lit(1)).alias("_rows")]
    for i, c in enumerate(columns):
        name = f"`{c}`"
        there = f"filter (where {name} is not null)"
        measures += [
            F.count(F.col(name)).alias(f"_n{i}"),
            F.expr(f"hll_sketch_agg(cast({name} as string), {LOG_REGISTERS}) {there}").alias(f"_d{i}"),
            F.expr(f"approx_top_k_accumulate(cast({name} as string), {TRACKED}) {there}").alias(f"_f{i}"),
        ]
        if isinstance(df.schema[c].dataType, NumericType):
            measures.append(F.expr(f"kll_sketch_agg_double(cast({name} as double)) {there}").alias(f"_q{i}"))
    wide = df.groupBy(*by).agg(*measures)
    types = dict(df.dtypes)
    rows = []
    for i, c in enumerate(columns):
        known = F.col(f"_n{i}") > 0
        quantiles = F.col(f"_q{i}") if f"_q{i}" in wide.columns else F.lit(None).cast("binary")
        rows.append(
            F.struct(
                F.lit(c).alias("column"),
                F.lit(types[c]).alias("type"),
                F.col("_rows").alias("rows"),
                F.col(f"_n{i}").alias("present"),
                F.when(known, F.col(f"_d{i}")).alias("distinct_sketch"),
                F.when(known, quantiles).alias("quantile_sketch"),
                F.when(known, F.col(f"_f{i}")).alias("frequent_sketch"),
            )
        )
    return wide.select(*by, F.explode(F.array(*rows)).alias("_r")).select(*by, "_r.*")


def store(sketches: DataFrame, root: str, by: list[str], due: list[tuple]) -> None:
    """Keep the sketches of the seasons named in ``due``; those of others stay."""
    replace_partitions(sketches, root, by, due)


def stored(spark: SparkSession, root: str, by: str) -> DataFrame:
    """Sketches on file; ``by`` declares the columns of the seasons."""
    return current(spark, root, f"{by}, {FIELDS}")


def merge(sketches: DataFrame, by: list[str] | None = None) -> DataFrame:
    """One row per column, or per column and ``by``, for all seasons given."""
    keys = [*(by or []), "column", "type"]
    counts = sketches.groupBy(*keys).agg(F.sum("rows").alias("rows"), F.sum("present").alias("present"))
    # The functions can't merge nothing: seasons without a value of the column are left out here.
    quantiles = F.expr("kll_merge_agg_double(quantile_sketch) filter (where quantile_sketch is not null)")
    merged = sketches.where("present > 0").groupBy(*keys).agg(
        F.expr("hll_union_agg(distinct_sketch)").alias("distinct_sketch"),
        F.when(F.count("quantile_sketch") > 0, quantiles).alias("quantile_sketch"),
        F.expr(f"approx_top_k_combine(frequent_sketch, {TRACKED})").alias("frequent_sketch"),
    )
    return counts.join(merged, keys, "left")


def profile(
    sketches: DataFrame, by: list[str] | None = None, *, quantiles: tuple[float, ...] = (0.25, 0.5, 0.75), top: int = 5
) -> DataFrame:
    """(by, column, type, rows, missing_pct, distinct_values, quantiles, frequent) of merged seasons."""
    merged = merge(sketches, by)
    ranks = ", ".join(f"{q}D" for q in quantiles)
    return merged.select(
        *(by or []),
        "column",
        "type",
        "rows",
        F.bround(100 * (F.col("rows") - F.col("present")) / F.col("rows"), 2).alias("missing_pct"),
        F.when(F.col("distinct_sketch").isNotNull(), F.expr("hll_sketch_estimate(distinct_sketch)")).otherwise(0).alias("distinct_values"),
        F.when(F.col("quantile_sketch").isNotNull(), F.expr(f"kll_sketch_get_quantile_double(quantile_sketch, array({ranks}))")).alias("quantiles"),
        F.when(F.col("frequent_sketch").isNotNull(), F.expr(f"approx_top_k_estimate(frequent_sketch, {top})")).alias("frequent"),
    )
