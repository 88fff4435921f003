"""What the linker moves: only what can still fit."""

from __future__ import annotations

from pathlib import Path

from matchwright.operators import linking
from matchwright.session import shared_dir
from matchwright.sources import sinks

SCHEMA = "winner_name string, loser_name string"


def test_readings_without_a_short_name_are_left_out(spark):
    feed = spark.createDataFrame([("Potro J.", "Kim T."), (None, "Kim T.")], SCHEMA)
    archive = spark.createDataFrame([("Juan Martin Del Potro", "Tony Kim"), ("Ann Other", None)], SCHEMA)
    _, full = linking.spelled(feed, archive)
    got = {(r.name, r.family, tuple(r.given)) for r in full.collect()}
    assert got == {("Juan Martin Del Potro", "potro", ("juan", "martin", "del")), ("Tony Kim", "kim", ("tony",))}
    every = {(r.name, r.family, tuple(r.given)) for r in linking.full_names(archive).collect()}
    assert got < every and len(every) == 8


def test_a_staged_table_is_not_staged_again(spark, tmp_path):
    def copies():
        return len(list(Path(f"{shared_dir(spark)}/matchwright").glob("replacement-*")))

    rows = spark.createDataFrame([("atp", 1999, "a"), ("atp", 2000, "b")], "tour string, year bigint, key string")
    rows.write.parquet(f"{tmp_path}/copy")
    copy, by, root = spark.read.parquet(f"{tmp_path}/copy"), ["tour", "year"], f"{tmp_path}/table"
    sinks.replace_partitions(copy, root, by, [], staged=False)
    before = copies()
    due = [("atp", 1999), ("atp", 2000)]
    sinks.replace_partitions(copy.where("year = 2000"), root, by, due, staged=True)
    assert copies() == before > 0
    assert [tuple(r) for r in spark.read.parquet(root).select("tour", "year", "key").collect()] == [("atp", 2000, "b")]
