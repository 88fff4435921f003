"""The check of manual links: what it finds, and that it joins no records by sorted keys."""

from matchwright.operators import linking


def test_manual_problems_count_keys_once(spark, monkeypatch):
    schema = "year bigint, tour string, {} string"
    feed = spark.createDataFrame([(1, "a", "f1"), (1, "a", "f2"), (1, "a", None), (2, "a", "f1")], schema.format("source_match_key"))
    archive = spark.createDataFrame([(1, "a", "k1"), (1, "a", "k1"), (1, None, "k9"), (2, "a", None)], schema.format("canonical_match_key"))
    rows = [
        (1, "a", "f1", "k1"), (1, "a", "f2", "k1"), (1, "a", "f3", "k2"), (1, "a", "f3", "k2"),
        (1, "a", None, "k1"), (2, "a", "f1", None), (2, "a", "f2", None), (3, "a", "f1", "k1"),
    ]
    manual = spark.createDataFrame(rows, "year bigint, tour string, source_match_key string, canonical_match_key string")
    found = linking.manual_problems(manual, feed, archive)
    assert found.columns == ["column", "match_key", "problem"]
    f, k = "source_match_key", "canonical_match_key"
    want = [
        (f, "f3", "named twice"), (f, "f3", "unknown"), (f, None, "unknown"), (f, "f2", "unknown"),
        (k, "k1", "named twice"), (k, "k2", "named twice"), (k, "k2", "unknown"),
        (k, None, "named twice"), (k, None, "unknown"),
    ]
    assert sorted(map(tuple, found.collect()), key=str) == sorted(want, key=str)
    assert "LeftAnti" not in found._jdf.queryExecution().optimizedPlan().toString()
