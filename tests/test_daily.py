"""Replayed batches, gates in one pass, stored candidates, whole numbers, folders of partitions."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from matchwright.functions import numbers
from matchwright.operators import linking, quality, sketches
from matchwright.plans import cleaning
from matchwright.sources import feed, files, sinks
from matchwright.streaming import refresh

HEADER = "ATP,Location,Tournament,Date,Series,Court,Surface,Round,Best of,Winner,Loser,WRank,LRank,W1,L1,Wsets,Lsets,Comment"
LINE = "1,Rome,Open,1/7/2024,ATP250,Outdoor,Hard,The Final,3,A B.,C D.,1,2,6,2,2,0,Completed"


def land(path, header, *lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join([header, *lines]) + "\n")
    return str(path)


def drift(spark, root):
    return {(r["column"], r.change) for r in spark.read.parquet(f"{root}/drift").collect()}


def test_a_replayed_batch_finds_its_drift_again(spark, tmp_path, monkeypatch):
    landing, root = tmp_path / "land", str(tmp_path / "store")
    season = landing / "tour=atp" / "year=2024"
    land(season / "a.csv", HEADER, LINE)
    refresh.refresh_seasons(spark, str(landing), root)
    land(season / "b.csv", HEADER.replace("WRank", "New"), LINE)
    clean = cleaning.clean_seasons

    def broken(*args, **kwargs):
        raise RuntimeError("lost")

    monkeypatch.setattr(cleaning, "clean_seasons", broken)
    with pytest.raises(Exception, match="lost"):
        refresh.refresh_seasons(spark, str(landing), root)
    monkeypatch.setattr(cleaning, "clean_seasons", clean)
    assert refresh.refresh_seasons(spark, str(landing), root).seasons == [("atp", 2024, 1, True)]
    assert drift(spark, root) == {("New", "added"), ("WRank", "removed")}
    refresh.refresh_seasons(spark, str(landing), root, always=[("atp", 2024)])
    assert drift(spark, root) == {("New", "added"), ("WRank", "removed")}
    ledger = spark.read.parquet(f"{root}/ledger").collect()
    assert sorted((r.batch, r.year, r.rows, r.success) for r in ledger) == [(0, 2024, 1, True), (1, 2024, 1, True)]


def test_one_pass_tells_the_same_as_its_parts(spark):
    s = "tour string, year bigint, source_match_key string, match_status string, v double, w double"
    rows = [("a", 1, "k", "completed", 1.0, None), ("a", 1, "k", None, None, 2.0), ("b", 1, "k", "odd", 0.5, 1.0), ("b", 2, "m", "completed", 3.0, 3.0)]
    df = spark.createDataFrame(rows, s)
    rules = {"low": F.col("v") < 1, "none": F.col("v").isNull()}
    got = quality.measure(df, rules, ["tour", "year"], needed=["v", "w"])
    told = lambda x: sorted(map(tuple, x.select(*sorted(x.columns)).collect()))
    assert told(got.violations()) == told(quality.violations(df, rules, ["tour", "year"], key="source_match_key"))
    assert told(got.report()) == told(quality.quality_report(df, ["tour", "year"], needed=["v", "w"]))
    assert told(got.rows()) == [(1, "b", 1), (1, "b", 2), (2, "a", 1)]


def test_candidates_of_a_crowded_block(spark, monkeypatch):
    monkeypatch.setattr(linking, "MEMBERS", 16)
    day = dt.date(2024, 1, 1)
    feed_side = [(f"f{i}", 2024, "t", 7, "F", "Fritz T.", "Nava E.", 1, 2, day) for i in range(60)]
    feed_side += [("g1", 2024, "t", 7, "F", "Fritz T.", "Bu Y.", None, 4, day), ("g2", 2024, "t", 8, "F", "A B.", "C D.", 5, 6, day)]
    other = [(f"k{i}", 2024, "t", 7, "F", "Taylor Fritz", "Emilio Nava", 1, 2, 1, 2) for i in range(50)]
    other += [(f"b{i}", 2024, "t", 7, "F", "Taylor Fritz", "Yunchaokete Bu", 8, 9, 1, 3) for i in range(2)]
    own = spark.createDataFrame(feed_side, "source_match_key string, year bigint, tour string, official_tournament_id bigint, round string, winner_name string, loser_name string, winner_rank bigint, loser_rank bigint, day date")
    truth = spark.createDataFrame(other, "canonical_match_key string, year bigint, tour string, official_tournament_id bigint, round string, winner_name string, loser_name string, winner_rank bigint, loser_rank bigint, winner_id bigint, loser_id bigint")
    out = linking.link(own, truth)
    found = out.candidates()
    lists = found.members.collect()
    assert sum(len(r["keys"]) for r in lists) <= 4 * (len(feed_side) + len(other)) and max(len(r["keys"]) for r in lists) < 60
    pairs = {(r.found_in_pass, r.source_match_key, r.canonical_match_key) for r in found.pairs().collect()}
    by_rank = {(1, r.source_match_key, r.canonical_match_key) for r in linking.rank_pairs(own, truth).collect()}
    by_name = {(2, r.source_match_key, r.canonical_match_key) for r in linking.name_pairs(own, truth).collect()}
    assert pairs == by_rank | by_name and found.pairs().count() == len(pairs)
    best = found.best(3).collect()
    for number, key in {(p, f) for p, f, _ in pairs}:
        every = sorted(k for p, f, k in pairs if (p, f) == (number, key))
        assert [r.canonical_match_key for r in sorted(best, key=lambda r: r.rank) if (r.found_in_pass, r.source_match_key) == (number, key)] == every[:3]


def test_whole_numbers_are_not_rounded(spark):
    texts = {"301.0": 301, "3e2": 300, "301.5": None, "301.00000000001": None, "9223372036854775807.0": 2**63 - 1, "9223372036854775808": None, "5e-99": None, "50e-1": 5, "-3.0e1": -30, "": None, " 7 ": 7, "1" + "." + "0" * 60: 1, "x": None}
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", numbers.to_long(F.col("t")).alias("n"))
    assert {r.t: r.n for r in df.collect()} == texts


def test_partitions_with_odd_values(spark, tmp_path):
    path, s = str(tmp_path / "t"), "a string, b bigint, v int"
    odd = ["x/y:z", "100%", "a=b", "é ü", None]
    rows = [(a, 1, i) for i, a in enumerate(odd)] + [("keep", 1, 9)]
    sinks.overwrite_partitions(spark.createDataFrame(rows, s), path, ["a", "b"])
    left = spark.createDataFrame([("x/y:z", 1, 50)], s)
    sinks.replace_partitions(left, path, ["a", "b"], [(a, 1) for a in odd])
    assert sorted((r.a, r.v) for r in spark.read.schema("v int, a string, b bigint").parquet(path).collect()) == [("keep", 9), ("x/y:z", 50)]


def test_raw_sink_keeps_what_a_wrong_drop_would_replace(spark, tmp_path):
    root = str(tmp_path / "raw")
    good = land(tmp_path / "a.csv", HEADER, LINE)
    assert feed.store_raw(spark, {("atp", 2024): good}, root).problems == []
    wrong = land(tmp_path / "b.csv", HEADER.replace("ATP,", "WTA,"), LINE, LINE)
    more = land(tmp_path / "c.csv", HEADER + ",New", LINE + ",1")
    told = feed.store_raw(spark, {("atp", 2024): wrong, ("atp", 2025): more}, root)
    assert [(y, rule) for _, y, rule, _ in told.problems][0] == (2024, "wrong_data_set")
    rows = {r.Year: r.New for r in feed.scan_stored_raw(spark, root, "atp").collect()}
    assert rows == {2024: None, 2025: 1.0}


def test_a_drop_that_lands_again_takes_back_what_it_said(spark, tmp_path, monkeypatch):
    landing, root = str(tmp_path / "drops"), str(tmp_path / "out")
    schema = "year int, v int, drop string, version int"

    def landed():
        every = spark.read.schema(schema).parquet(landing)
        last = every.groupBy("drop").agg(F.max("version").alias("version"))
        return every.join(last, ["drop", "version"], "left_semi")

    def run(rows):
        if rows:
            spark.createDataFrame(rows, schema).write.mode("append").partitionBy("drop", "version").parquet(landing)
        refresh.refresh_drops(
            spark.readStream.schema(schema).parquet(landing),
            landed,
            lambda df: {"sums": df.groupBy("drop", "year").agg(F.sum("v").alias("v"))},
            lambda parts: parts["sums"].groupBy("year").agg(F.sum("v").alias("v")),
            root,
            str(tmp_path / "checkpoint"),
            ["year"],
        )
        return sorted((r.year, r.v) for r in spark.read.schema("v bigint, year int").parquet(f"{root}/summary").collect())

    assert run([(1, 10, "a", 1), (2, 20, "a", 1), (2, 5, "b", 1)]) == [(1, 10), (2, 25)]
    replace = refresh.replace_partitions

    def broken(df, path, *args, **kwargs):
        if path.endswith("summary"):
            raise RuntimeError("lost")
        return replace(df, path, *args, **kwargs)

    monkeypatch.setattr(refresh, "replace_partitions", broken)
    with pytest.raises(Exception, match="lost"):
        run([(1, 11, "a", 2), (3, 30, "c", 1)])
    monkeypatch.setattr(refresh, "replace_partitions", replace)
    assert run([]) == [(1, 11), (2, 5), (3, 30)]
    assert run([(2, 7, "b", 2)]) == [(1, 11), (2, 7), (3, 30)]


def test_many_headers_are_one_scan(spark, tmp_path):
    pick = random.Random(1)
    names = [f"c{i}" for i in range(12)]
    want = []
    for i in range(60):
        header = pick.sample(names, pick.randint(2, 12))
        values = {c: pick.choice(["1", "", "x y", 'say \\"a\\", b']) for c in header}
        line = ",".join(f'"{values[c]}"' if "," in values[c] else values[c] for c in header)
        land(tmp_path / f"{i % 7}" / f"f {i}.csv", ",".join(header), line, line + ",more", ",".join(header))
        plain = {c: v.replace("\\", "") or None for c, v in values.items()}
        want.append(tuple(plain.get(c) for c in names))
    df = files.read_text_csv(spark, [str(tmp_path / str(k)) for k in range(7)])
    assert df._jdf.queryExecution().executedPlan().toString().count("FileScan") <= 1
    rows = df.collect()
    good = sorted((tuple(r[c] for c in names) for r in rows if r[files.RAGGED] is None), key=str)
    assert good == sorted(want, key=str)
    assert len(rows) == 120 and all(r[files.RAGGED].endswith(",more") for r in rows if r[files.RAGGED])


def test_merged_sketches_equal_those_of_all_rows(spark, tmp_path):
    rows = [(y, i % (10 * y), float(i) if i % 4 else None, None, "ab"[i % 3 == 0]) for y in (1, 2, 3) for i in range(400)]
    df = spark.createDataFrame(rows, "year int, k int, v double, none string, `a b` string")
    root = str(tmp_path / "sketches")
    sketches.store(sketches.sketch(df, ["year"]), root, ["year"], [(1,), (2,), (3,)])
    on_file = sketches.stored(spark, root, "year int")
    got = {r["column"]: r for r in sketches.profile(on_file, quantiles=(0.5,), top=2).collect()}
    assert (got["k"].rows, got["k"].distinct_values, got["v"].missing_pct, got["none"].missing_pct) == (1200, 30, 25.0, 100.0)
    assert got["none"].distinct_values == 0 and got["none"].quantiles is None and got["none"].frequent is None
    assert abs(got["v"].quantiles[0] - 200) <= 12 and got["a b"].quantiles is None
    assert [tuple(f) for f in got["a b"].frequent] == [("a", 798), ("b", 402)]
    by_year = sketches.profile(on_file, ["year"]).where("column = 'k'").collect()
    assert {r.year: r.distinct_values for r in by_year} == {1: 10, 2: 20, 3: 30}
    sketches.store(sketches.sketch(df.where("k < 0"), ["year"]), root, ["year"], [(3,)])
    assert sketches.profile(sketches.stored(spark, root, "year int")).where("column = 'k'").first().distinct_values == 20
    assert sketches.profile(sketches.stored(spark, str(tmp_path / "none"), "year int")).collect() == []
