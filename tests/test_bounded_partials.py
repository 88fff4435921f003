"""Partials of a roll-up: no task sorts its rows for carried texts, and files have few rows."""

from datetime import date

from pyspark.sql import functions as F

from matchwright import session
from matchwright.operators import rollup
from matchwright.sources.sinks import replace_partitions

SPEC = rollup.RollUp(keys=["event"], attributes=["surface"], day="day", carry=["label"])


def _rows(spark):
    data = [("d1", "a", "clay", "x2"), ("d1", "a", "hard", None), ("d2", "a", "hard", "x1"), ("d2", "b", None, None)]
    rows = spark.createDataFrame(data, "drop string, event string, surface string, label string")
    return rows.withColumn("day", F.lit(date(2020, 1, 1)))


def test_carried_value_is_the_smallest_of_all_parts(spark):
    parts = rollup.partials(_rows(spark), SPEC, ("drop",))
    for merged in (rollup.merged(parts, SPEC), rollup.partials(_rows(spark), SPEC)):
        got = rollup.entities(merged, SPEC).select("event", "surface", "num_matches", "label").collect()
        assert {tuple(r) for r in got} == {("a", "hard", 3, "x1"), ("b", None, 1, None)}


def test_partials_with_the_carried_value_in_every_row_still_merge(spark):
    parts = rollup.partials(_rows(spark), SPEC, ("drop",))
    old = {"values": parts["values"].withColumn("_carry_label", F.lit("x0"))}
    got = rollup.entities(rollup.merged(old, SPEC), SPEC).select("event", "num_matches", "label").collect()
    assert {tuple(r) for r in got} == {("a", 3, "x0"), ("b", 1, "x0")}


def test_values_are_not_sorted(spark):
    values = rollup.partials(_rows(spark), SPEC, ("drop",))["values"]
    assert "SortAggregate" not in values._jdf.queryExecution().executedPlan().toString()


def test_files_have_a_bounded_number_of_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "FILE_ROWS", 10)
    staged = session.stage(spark.range(100).coalesce(1), "bounded")
    assert len(staged.inputFiles()) == 10 and staged.count() == 100
    path = str(tmp_path / "kept")
    replace_partitions(staged.withColumn("part", F.lit(1)), path, ["part"], [(1,)], staged=True, file_rows=10)
    kept = spark.read.parquet(path)
    assert len(kept.inputFiles()) >= 10 and kept.count() == 100
