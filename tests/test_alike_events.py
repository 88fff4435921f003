"""Candidates of events that are equal but for their ids."""

from __future__ import annotations

from pyspark.sql import functions as F

from matchwright.operators import candidates, matching

SCHEMA = "year int, id bigint, name string, surface string, start_date date"


def _side(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def _got(found):
    rows = [(r.year, r.l_id, r.r_id, round(r.score, 6)) for r in found.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_equal_events_are_scored_once(spark, monkeypatch):
    """Lists of ids are cut, ids have several rows or are null; as many pairs as without kinds."""
    monkeypatch.setattr(candidates, "MEMBERS", 4)
    left = [(1, i, "open a", "hard", None) for i in range(10)] + [(2, 3, "open a", "hard", None)]
    left += [(1, 3, "open b", "clay", None), (1, 3, "open a", "hard", None), (1, None, "open a", "hard", None), (1, None, "open b", "hard", None)]
    right = [(1, 100 + i, "open a", "clay", None) for i in range(7)] + [(1, 102, "open b", "hard", None), (None, 5, "open a", "hard", None)]
    side = matching.Side("id", ["name"])
    sides = _side(spark, left), _side(spark, right)
    l, r = (candidates.prepared(df, side, ["year"]) for df in sides)
    plain = candidates._met(l, r, ["year"], candidates.Rule(0.5, 10), None)
    found = matching.candidates(*sides, side, side, block=["year"], floor=0.5)
    assert _got(found) == _got(plain) and len(_got(found)) > 70


def test_pairs_of_equal_events_cross_no_exchange(spark, monkeypatch):
    """What is scored doesn't grow with the copies of an event."""
    seen = []
    real = candidates._met
    monkeypatch.setattr(candidates, "_met", lambda *args: seen.append(real(*args)) or seen[-1])
    side = matching.Side("id", ["name"])
    one = spark.range(300).select(
        F.lit(1).alias("year"), "id", F.lit("open").alias("name"), F.lit("hard").alias("surface"), F.lit(None).cast("date").alias("start_date")
    )
    found = matching.candidates(one, one, side, side, block=["year"], floor=0.5)
    assert found.count() == 90_000
    assert seen[0].count() == 1
