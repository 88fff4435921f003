"""Repeated keys are counted behind an exchange, not where a split of the rows is held already."""

from pyspark.sql import functions as F

from matchwright.operators import quality


def test_keys_are_rebalanced_and_counted(spark):
    data = [("x", 1, k) for k in ("a", "a", "a", "b", None, None)] + [("x", 2, "a"), (None, 2, "a"), (None, 2, "a")]
    rows = spark.createDataFrame(data, "tour string, year int, key string")
    out = quality._beyond_first(rows, ["tour", "year"], "key", "extra")
    assert {tuple(r) for r in out.collect()} == {("x", 1, 3), ("x", 2, 0), (None, 2, 1)}
    broken = quality.violations(rows.where("tour = 'x'"), {"never": F.lit(False)}, ["tour", "year"], key="key")
    assert [tuple(r) for r in broken.collect()] == [("x", 1, "duplicate_key", 3)]
    plan = broken._jdf.queryExecution().executedPlan().toString()
    assert "REBALANCE_PARTITIONS_BY_COL" in plan
