import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from matchwright.operators import (
    brackets, columns, corrections, identity, joins, matching, merge, ordering, profile, quality, rollup,
)
from matchwright.functions.similarity import sequence_ratio


def d(text):
    return dt.date.fromisoformat(text)


# --- roll-up ---

CLEAN = "tour string, year int, uk_tournament_id int, location string, tournament_name string, series string, surface string, best_of int, is_outdoor boolean, match_date date, round string, winner_name string, loser_name string, match_status string, winner_rank int, odds double, source_event_key string"


def match(**k):
    base = dict(tour="atp", year=2023, uk_tournament_id=1, location="Adelaide", tournament_name="Adelaide International 1", series="atp_250", surface="hard", best_of=3, is_outdoor=True, match_date=d("2023-01-01"), round="R16", winner_name="A", loser_name="B", match_status="completed", winner_rank=10, odds=1.5, source_event_key="e1")
    return tuple({**base, **k}.values())


SPEC = rollup.RollUp(keys=["tour", "year", "uk_tournament_id", "location"], attributes=["tournament_name", "series", "surface", "best_of", "is_outdoor"], day="match_date", winner="winner_name", loser="loser_name", stage="round", status="match_status", statuses=["completed", "retired"], rank="winner_rank", odds="odds", carry=["source_event_key"])


def test_roll_up(spark):
    df = spark.createDataFrame(
        [match(), match(match_date=d("2023-01-03"), round="F", winner_rank=11, odds=1.7, loser_name="C"), match(match_date=d("2023-01-02"), winner_name="C", loser_name="D", match_status="retired", best_of=5)], CLEAN
    )
    r = rollup.roll_up(df, SPEC).collect()
    assert len(r) == 1
    r = r[0]
    assert (r.start_date, r.end_date, r.num_matches, r.num_rounds, r.num_players) == (d("2023-01-01"), d("2023-01-03"), 3, 2, 4)
    assert (r.champion, r.runner_up, r.champion_avg_rank, r.champion_avg_odds) == ("A", "C", 10.5, 1.6)
    assert (r.num_completed_matches, r.num_retired_matches, r.best_of, r.is_outdoor, r.source_event_key) == (2, 1, 3, True, "e1")
    bad = rollup.audit(df, SPEC).collect()
    assert len(bad) == 1 and bad[0].best_of == 2 and bad[0].surface == 1


def test_roll_up_splits_places_and_smallest_mode(spark):
    df = spark.createDataFrame([match(uk_tournament_id=58, location="Stockholm", best_of=5), match(uk_tournament_id=58, location="Tokyo", best_of=None), match(uk_tournament_id=58, location="Stockholm", best_of=3), match(location=None)], CLEAN)
    rows = {r.location: r for r in rollup.roll_up(df, SPEC).collect()}
    assert set(rows) == {"Stockholm", "Tokyo"}
    assert rows["Stockholm"].best_of == 3 and rows["Tokyo"].best_of is None and rows["Tokyo"].champion is None
    with pytest.raises(KeyError):
        rollup.roll_up(df.drop("surface"), SPEC)


# --- brackets ---

ROUND_MAP = {"Quarterfinals": "QF", "Semifinals": "SF", "The Final": "F", "Round Robin": "RR"}


def test_round_codes(spark):
    rows = [("a", r) for r in ["1st Round", "2nd Round", "Quarterfinals", "Semifinals", "The Final", "junk"]]
    rows += [("b", r) for r in ["1st Round", "2nd Round", "3rd Round", "4th Round", "Quarterfinals"]]
    df = spark.createDataFrame([(e, r, r) for e, r in rows], "e string, label string, round string")
    got = {(r.e, r.label): r["round"] for r in brackets.assign_round_codes(df, "e", "round", ROUND_MAP).collect()}
    assert [got[("a", r)] for _, r in rows[:6]] == ["R32", "R16", "QF", "SF", "F", None]
    assert [got[("b", r)] for _, r in rows[6:]] == ["R128", "R64", "R32", "R16", "QF"]


@pytest.mark.parametrize("late", [False, True])
def test_group_field(spark, late):
    rows = []
    for g in "xy":
        names = [f"{g}{i}" for i in range(4)]
        rows += [("e", "RR", a, b) for i, a in enumerate(names) for b in names[i + 1 :]]
    if late:
        rows[0] = ("e", "RR", "x0", "late")
    rows.append(("e", "F", "x0", "y0"))
    df = spark.createDataFrame(rows, "source_event_key string, round string, winner_name string, loser_name string")
    got = {(r["round"], r.players_remaining) for r in brackets.add_players_remaining(df).collect()}
    assert got == {("RR", 8), ("F", 2)}


# --- columns, corrections ---


def test_columns(spark):
    df = spark.createDataFrame([("ATP250", "Outdoor", 0.8), ("New", None, 2.0)], "series string, court string, o double")
    got = df.select(columns.recode(F.col("series"), {"ATP250": "atp_250"}), columns.recode(F.col("court"), {"Indoor": False, "Outdoor": True}, keep_unmapped=False)).collect()
    assert [tuple(r) for r in got] == [("atp_250", True), ("New", None)]
    assert [r.o for r in columns.null_invalid(df, ["o", "nope"]).collect()] == [None, 2.0]
    assert columns.count_invalid(df, ["o"]).first().removed == 1
    assert columns.ensure_columns(df, {"o": "double", "p": "double"}).columns == ["series", "court", "o", "p"]
    got = columns.rewrite(df, [("series", F.col("series") == "New", "ATP500"), ("o", F.col("court") == "x", 9.0)]).collect()
    assert [tuple(r) for r in got] == [("ATP250", "Outdoor", 0.8), ("ATP500", None, 2.0)]
    assert df.where(columns.not_equal(F.col("court"), "Outdoor")).count() == 1


def test_swap(spark):
    df = spark.createDataFrame([(2020, 2, "Auckland"), (2020, 3, "Adelaide"), (2020, 2, "Auckland"), (2019, 2, "Doha"), (2020, 5, "X")], "y int, id int, loc string")
    got = sorted(tuple(r) for r in columns.swap_blocks(df, "id", 2, 3, ["id", "loc"], F.col("y") == 2020).collect())
    assert got == [(2019, 2, "Doha"), (2020, 2, "Auckland"), (2020, 3, "Adelaide"), (2020, 3, "Adelaide"), (2020, 5, "X")]


def test_corrections(spark):
    df = spark.createDataFrame(
        [("atp", 2024, 7, "A", "B", d("2024-01-01"), 1, 2, "Completed"), ("wta", 2024, 7, "A", "B", None, 1, 2, "Completed"), ("atp", 2024, 8, "C", "C", d("2024-01-01"), 1, 2, "x"), ("atp", 2024, 8, "C", "C", d("2024-01-01"), 1, 2, "x")],
        "tour string, year int, id int, w string, l string, day date, w1 int, l1 int, c string",
    )
    fixes = spark.createDataFrame(
        [("f1", "atp", 2024, 7, "A", "B", d("2024-01-01"), {"c": "Retired", "w1": "6"}), ("f2", "wta", 2024, 7, "A", "B", None, {"w1": "=l1", "l1": "=w1"}), ("f3", "atp", 2024, 99, "Z", "Z", None, {"c": "x"}), ("f4", "atp", 2024, 8, "C", "C", d("2024-01-01"), {"c": "y"}), ("f5", "atp", 2020, 8, "C", "C", d("2024-01-01"), {"c": "y"})],
        corrections.CORRECTION_SCHEMA,
    )
    keys = dict(tour="tour", year="year", event_id="id", winner="w", loser="l", match_date="day")
    got = {(r.tour, r.id): (r.w1, r.l1, r.c) for r in corrections.apply_corrections(df, fixes, keys).collect()}
    assert got[("atp", 7)] == (6, 2, "Retired") and got[("wta", 7)] == (2, 1, "Completed")
    assert {r.fix_id: r.hits for r in corrections.correction_hits(df, fixes, keys).collect()} == {"f1": 1, "f2": 1, "f3": 0, "f4": 2}
    assert {r.fix_id for r in corrections.wrong_corrections(df, fixes, keys).collect()} == {"f3", "f4"}


# --- merge ---


def test_upsert(spark):
    old = spark.createDataFrame([("b", 2, 5), ("a", 1, 3)], "k string, v int, num_matches int")
    new = spark.createDataFrame([("a", 999), ("c", 7)], "k string, v int")
    assert sorted(tuple(r) for r in merge.upsert(old, new, ["k"]).collect()) == [("a", 999, 0), ("b", 2, 5), ("c", 7, 0)]
    assert sorted(tuple(r) for r in merge.upsert(old, new, ["k"], keep="first").collect()) == [("a", 1, 3), ("b", 2, 5), ("c", 7, 0)]
    with pytest.raises(ValueError):
        merge.upsert(old, new, ["k"], keep="any")


@pytest.mark.parametrize("old,new,forced,want", [(None, 404, False, 404), (404, 999, False, 404), (2059, 2058, True, 2058), (404, None, False, 404)])
def test_priority_merge(spark, old, new, forced, want):
    s = "official_tournament_id bigint, year bigint, source string, source_tournament_id string"
    a, b = spark.createDataFrame([(old, 2016, "sackmann", "2016-M006")], s), spark.createDataFrame([(new, 2016, "sackmann", "2016-M006")], s)
    key = "2016-M006" if forced else "other"
    manual = spark.createDataFrame([(2016, None, key, 1)], "year bigint, uk_source_event_key string, sackmann_tourney_id string, official_tournament_id bigint")
    rows = merge.priority_merge(a, b, merge.forced_keys(manual, 'tennis_data_uk', 'sackmann')).collect()
    assert [r.official_tournament_id for r in rows] == [want]


def test_conflicts(spark):
    s = "location_key string, official_tournament_id bigint, location string"
    old = spark.createDataFrame([("singapore", 808, "x"), ("paris", 1, "x"), ("paris|a", 1, "x"), ("rome", 5, "x")], s)
    new = spark.createDataFrame([("singapore", 1096, "x"), ("paris", 2, "x"), ("paris|b", 3, "x"), ("rome", 5, "x")], s)
    assert [tuple(r) for r in merge.conflict_report(old, new).collect()] == [("singapore", 1096, 808)]


def test_replace_and_append(spark):
    s = "y int, k string, v int"
    old, new = spark.createDataFrame([(1, "a", 1), (2, "b", 1), (None, "c", 1)], s), spark.createDataFrame([(2, "d", 2), (2, "b", 9)], s)
    assert sorted(str(tuple(r)) for r in merge.replace_period(old, new, F.col("y") == 2, ["y", "k"]).collect()) == ["(1, 'a', 1)", "(2, 'b', 9)", "(2, 'd', 2)", "(None, 'c', 1)"]
    assert sorted(str(tuple(r)) for r in merge.append_new(old, new, ["y", "k"]).collect()) == ["(1, 'a', 1)", "(2, 'b', 1)", "(2, 'd', 2)", "(None, 'c', 1)"]


def test_dedupe_nulls_are_equal(spark):
    df = spark.createDataFrame([(None, 2, "x"), (None, 1, "y"), ("a", 1, None)], "k string, o int, v string")
    assert sorted(str(tuple(r)) for r in ordering.dedupe(df, ["k"], [F.col("o")]).collect()) == ["('a', 1, None)", "(None, 1, 'y')"]
    assert sorted(str(tuple(r)) for r in ordering.dedupe(df, ["k"], [F.col("o")], "last").collect()) == ["('a', 1, None)", "(None, 2, 'x')"]


# --- fuzzy matching ---


def brute_greedy(rows):
    used_l, used_r, out = set(), set(), set()
    for b, l, r, s, t in sorted(rows, key=lambda x: (-x[3], x[4], x[1], x[2])):
        if (b, l) not in used_l and (b, r) not in used_r:
            used_l.add((b, l))
            used_r.add((b, r))
            out.add((b, l, r))
    return out


def test_greedy_equals_the_sorted_walk(spark):
    rng = random.Random(5)
    rows = [(b, f"l{l}", f"r{r}", rng.choice([0.5, 0.6, 0.7, 0.9])) for b in range(25) for l in range(rng.randint(1, 7)) for r in range(rng.randint(1, 7)) if rng.random() < 0.8]
    df = spark.createDataFrame(rows, "b int, l_id string, r_id string, score double")
    got = {(r.b, r.l_id, r.r_id) for r in matching.assign(df, ["b"]).collect()}
    assert got == brute_greedy([tuple(r) for r in df.withColumn("t", F.md5(F.concat_ws("|", "l_id", "r_id"))).collect()])


def test_greedy_all_ties_needs_few_rounds(spark):
    df = spark.range(40).crossJoin(spark.range(40).withColumnRenamed("id", "r_id")).selectExpr("1 b", "id l_id", "r_id", "0.7D score")
    assert matching.assign(df, ["b"]).count() == 40


def test_candidates_lose_nothing(spark):
    rng = random.Random(7)
    names = ["montpellier", "montpelier", "open sud de france", "paris", "paris masters", "rome", "roma", "", "munich"]
    def side(prefix, n):
        return [(f"{prefix}{i}", rng.choice(names), rng.choice(names), rng.choice(["hard", "clay", None]), d("2025-01-01") + dt.timedelta(days=rng.randint(0, 40)) if rng.random() < 0.9 else None) for i in range(n)]
    s = "id string, n1 string, n2 string, surface string, start_date date"
    a, b = spark.createDataFrame(side("l", 30), s).withColumn("y", F.lit(1)), spark.createDataFrame(side("r", 30), s).withColumn("y", F.lit(1))
    for floor in (0.5, 0.8, 0.3):
        got = {(r.l_id, r.r_id): r.score for r in matching.candidates(a, b, matching.Side("id", ["n1", "n2"]), matching.Side("id", ["n1"]), block=["y"], floor=floor).collect()}
        want = {}
        from difflib import SequenceMatcher
        for x in a.collect():
            for z in b.collect():
                name = max(SequenceMatcher(None, n, z.n1).ratio() for n in (x.n1, x.n2))
                day = max(0.0, 1 - abs((x.start_date - z.start_date).days) / 10) if x.start_date and z.start_date else 0.0
                score = 0.5 * name + 0.4 * day + 0.1 * float(x.surface is not None and x.surface == z.surface)
                if score >= floor:
                    want[(x.id, z.id)] = score
        assert got == want


UK_EVENT = "tour string, year int, uk_tournament_id int, source_event_key string, tournament_name string, location string, surface string, start_date date, end_date date"
K_EVENT = "tour string, year int, tourney_id string, tournament_name string, surface string, start_date date, end_date date"
MANUAL = "tour string, year int, uk_source_event_key string, sackmann_tourney_id string, official_tournament_id bigint"
U1 = ("atp", 2025, 1, "2025_1_montpellier_open_sud_de_france", "Open Sud de France", "Montpellier", "hard", d("2025-01-27"), d("2025-02-02"))
K1 = ("atp", 2025, "2025-0375", "Montpellier", "hard", d("2025-01-27"), d("2025-02-02"))


def test_match_events(spark):
    u, k = spark.createDataFrame([U1], UK_EVENT), spark.createDataFrame([K1], K_EVENT)
    out = matching.match_events(u, k)
    assert [tuple(r) for r in out.links.collect()] == [("atp", 2025, U1[3], "2025-0375", 375)]
    assert out.review.first().score == 1.0
    far = spark.createDataFrame([("atp", 2025, "2025-7696", "Next Gen Finals", "hard", d("2025-12-17"), d("2025-12-17"))], K_EVENT)
    rows = {(r.uk_source_event_key, r.sackmann_tourney_id) for r in matching.match_events(u, far).links.collect()}
    assert rows == {(U1[3], None), (None, "2025-7696")}
    forced = spark.createDataFrame([("atp", 2025, U1[3], "2025-0375", None), ("atp", 2024, "x", "y", 5)], MANUAL)
    out = matching.match_events(u, k, forced)
    assert [r.official_tournament_id for r in out.links.collect()] == [375] and out.review.count() == 0
    k2 = spark.createDataFrame([("atp", 2025, "2016-M006", *K1[3:])], K_EVENT)
    by_id = spark.createDataFrame([("atp", 2025, None, "2016-M006", 404)], MANUAL)
    assert matching.match_events(u, k2, by_id).links.first().official_tournament_id == 404
    only_u = spark.createDataFrame([("atp", 2025, U1[3], None, 1066)], MANUAL)
    rows = {(r.uk_source_event_key, r.official_tournament_id) for r in matching.match_events(u, far, only_u).links.collect()}
    assert (U1[3], 1066) in rows


def test_catalog_and_backfill(spark):
    k = spark.createDataFrame([("wta", 2010, "2010-W-INT-THA-01A-2010", "Pattaya", "hard", d("2010-02-08"), None), ("wta", 2010, "2010-x", "Nowhere", "clay", d("2010-09-01"), None)], K_EVENT)
    a = spark.createDataFrame([("wta", 2010, 303, "PATTAYA CITY", "PTT PATTAYA WOMEN'S OPEN - PATTAYA CITY, THAILAND", "Hard", d("2010-02-08"))], "tour string, year int, official_tournament_id bigint, group_name string, title string, surface string, start_date date")
    found = matching.match_catalog(k, a)
    assert [(r.sackmann_tourney_id, r.official_tournament_id) for r in found.collect()] == [("2010-W-INT-THA-01A-2010", 303)]
    links = spark.createDataFrame([("2010-W-INT-THA-01A-2010", None), ("z", 999)], "sackmann_tourney_id string, official_tournament_id bigint")
    assert sorted(r.official_tournament_id for r in matching.backfill_ids(links, found).collect()) == [303, 999]


def test_identity(spark):
    u = spark.createDataFrame([("a", "Paris", "French Open"), ("b", "Paris", "BNP Paribas Masters"), ("c", "Montpellier", "Open Sud de France")], "source_event_key string, location string, tournament_name string")
    links = spark.createDataFrame([(2025, "a", "2025-0520", 520), (2025, "b", "2025-0352", 352), (2025, "c", "2025-0375", 375), (2025, None, "2025-1", None)], "year int, uk_source_event_key string, sackmann_tourney_id string, official_tournament_id bigint")
    got = {r.location_key: r.official_tournament_id for r in identity.location_crosswalk(links, u).collect()}
    assert got == {"paris|french open": 520, "paris|bnp paribas masters": 352, "montpellier": 375}
    long = identity.source_links(links)
    assert long.count() == 7
    wide = {r.official_tournament_id: (r.tennis_data_uk_id, r.sackmann_id) for r in identity.pivot_links(long).collect()}
    assert wide == {520: ("a", "2025-0520"), 352: ("b", "2025-0352"), 375: ("c", "2025-0375")}


# --- quality, profile, joins ---


def test_gates(spark):
    good = dict(tour="atp", year=2024, surface="hard", round="F", players_remaining=2, match_date=d("2024-01-05"), winner_name="A", loser_name="B", best_of=3, match_status="completed", winner_set_1_games=6, loser_set_1_games=1, winner_sets=2, loser_sets=0, o=1.5, k="k1")
    s = "tour string, year int, surface string, round string, players_remaining int, match_date date, winner_name string, loser_name string, best_of int, match_status string, winner_set_1_games int, loser_set_1_games int, winner_sets int, loser_sets int, o double, k string"
    rules = quality.clean_rules(odds=["o"])

    def broken(**change):
        df = spark.createDataFrame([tuple(good.values()), tuple({**good, "k": "k2", **change}.values())], s)
        return {r.rule: r.rows for r in quality.violations(df, rules, ["tour", "year"], key="k").collect()}

    assert broken() == {}
    assert broken(match_date=d("2023-12-30")) == {}
    assert broken(match_date=d("2023-11-30")) == {"date_outside_season": 1}
    assert broken(match_date=None) == {"missing_match_date": 1, "date_outside_season": 1}
    assert broken(surface="ice", best_of=None, k="k1") == {"unexpected_surface": 1, "unexpected_best_of": 1, "duplicate_key": 1}
    assert broken(players_remaining=None, winner_name="B", o=0.5) == {"missing_players_remaining": 1, "winner_is_loser": 1, "o_below_1": 1}
    assert broken(loser_sets=2, loser_set_1_games=None) == {"completed_without_first_set": 1, "completed_winner_sets_not_above": 1}
    assert broken(loser_sets=2, match_status="retired") == {}


def test_quality_report(spark):
    df = spark.createDataFrame([("atp", 2024, "completed", "a", 1.5), ("atp", 2024, "completed", "a", None), ("atp", 2024, "retired", "b", None), ("wta", 2024, None, "c", 1.0)], "tour string, year int, match_status string, source_match_key string, o double")
    long = quality.quality_report(df, ["tour", "year"], needed=["o"])
    got = {(r.tour, r.metric): r.value for r in long.collect()}
    assert got == {("atp", "rows"): 3, ("atp", "duplicate_match_keys"): 1, ("atp", "status_count_completed"): 2, ("atp", "status_count_retired"): 1, ("atp", "completed_missing_odds"): 1, ("atp", "missing_pct_o"): 66.6667, ("wta", "rows"): 1, ("wta", "duplicate_match_keys"): 0, ("wta", "completed_missing_odds"): 0, ("wta", "status_count_nan"): 1, ("wta", "missing_pct_match_status"): 100.0}
    wide = quality.wide_report(long, ["tour", "year"], ["rows", "status_count_retired"]).orderBy("tour").collect()
    assert [tuple(r) for r in wide] == [("atp", 2024, 3.0, 1.0), ("wta", 2024, 1.0, 0.0)]


def test_drift_and_guards(spark):
    assert quality.schema_drift(["a", "BFEW"], ["a", "b"]) == {"added": ["BFEW"], "removed": ["b"]}
    df = spark.createDataFrame([(1, "WTA")], "WTA int, x string")
    quality.require_own_dataset(df, "WTA", ["ATP"])
    with pytest.raises(ValueError, match="wrong data set"):
        quality.require_own_dataset(df, "ATP", ["WTA"])
    with pytest.raises(ValueError, match="unique"):
        quality.require_unique(spark.createDataFrame([(1,), (1,)], "k int"), ["k"], "keys")
    seen = spark.createDataFrame([(1, "a"), (1, "b"), (2, "b"), (2, "c"), (4, "c")], "s int, c string")
    assert {tuple(r) for r in quality.presence_drift(seen, "s", "c").collect()} == {(2, "a", "removed"), (2, "c", "added")}


def test_reused_ids(spark):
    df = spark.createDataFrame([(2023, 58, "Stockholm", "x"), (2023, 58, "Tokyo", "x"), (2023, 59, "Rome", "y")], "y int, id int, loc string, t string")
    assert [(r.id, r["loc"], r.t) for r in quality.reused_ids(df, "id", ["loc", "t"], ["y"]).collect()] == [(58, 2, 1)]


def test_interval_join_equals_all_pairs(spark):
    rng = random.Random(1)
    a = spark.createDataFrame([(rng.randint(0, 1), rng.randint(-50, 50), i) for i in range(60)], "k int, p int, i int")
    b = spark.createDataFrame([(rng.randint(0, 1), rng.randint(-50, 50), i) for i in range(60)], "k int, q int, j int")
    for low, high in ((-2, 25), (0, 0), (3, 9)):
        got = joins.interval_join(a, b, ["k"], F.col("p"), F.col("q"), low, high)
        want = a.join(b, "k").where(F.col("q").cast("int") - F.col("p") >= low).where(F.col("q") - F.col("p") <= high)
        assert sorted((r.i, r.j) for r in got.collect()) == sorted((r.i, r.j) for r in want.collect())


def test_alias_linker(spark):
    f = [("atp", i, d("2024-01-05"), "A", "B", i, i + 1) for i in (1, 2)] + [("atp", 9, d("2024-02-05"), "A", "B", None, None), ("atp", 10, d("2024-02-05"), "A", "Z", None, None)]
    a = [("atp", 100 + i, d("2024-01-01"), 7, 8, i, i + 1) for i in (1, 2)] + [("atp", 109, d("2024-02-01"), 7, 8, 50, 60)]
    feed = spark.createDataFrame(f, "tour string, feed_id int, day date, winner string, loser string, winner_rank int, loser_rank int")
    arch = spark.createDataFrame(a, "tour string, archive_id int, day date, winner_id int, loser_id int, winner_rank int, loser_rank int")
    got = {tuple(r) for r in profile.link_by_aliases(feed, arch).collect()}
    assert got == {(1, 101, "rank"), (2, 102, "rank"), (9, 109, "name")}


def test_window_links_with_a_hot_key(spark):
    rng = random.Random(4)
    f = spark.createDataFrame([(rng.choice([0, i]), i, d("2024-01-01") + dt.timedelta(days=rng.randint(0, 9))) for i in range(90)], "k int, feed_id int, feed_day date")
    a = spark.createDataFrame([(rng.choice([0, i]), i, d("2024-01-01") + dt.timedelta(days=rng.randint(0, 9))) for i in range(90)], "k int, archive_id int, archive_day date")
    pairs = f.join(a, "k").where(F.datediff("feed_day", "archive_day").between(-2, 3))
    want = {(r.feed_id, r.archive_id) for r in profile.unique_both(pairs, "feed_id", "archive_id").collect()}
    got = {(r.feed_id, r.archive_id) for r in profile.unique_in_window(f, a, ["k"], -2, 3).collect()}
    assert got == want and want


def test_profile(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (2, "a")], "x int, y string")
    assert [tuple(r) for r in profile.column_profile(df, exact=True).collect()] == [("x", "int", 0.0, 2), ("y", "string", 33.33, 1)]
    got = profile.pair_agreement(spark.createDataFrame([(1, 1), (1, 2), (None, 1)], "a int, b int"), {"c": (F.col("a"), F.col("b"))}).first()
    assert got.agreement_pct == 50.0
    ids = joins.disagreeing_ids(spark.createDataFrame([("k", 1), ("m", 2), ("n", None)], "k string, w int"), spark.createDataFrame([("k", 1), ("m", 3), ("n", 4)], "k string, w int"), "k", ["w"])
    assert {r.k for r in ids.collect()} == {"m", "n"}


# --- tours, corrections, exact values ---


def test_ids_belong_to_their_tour(spark):
    bridge = spark.createDataFrame([("atp", 1, "s", "e", 10), ("wta", 1, "s", "e", 20), ("atp", 1, "s", "e", 10)], "tour string, year int, source string, source_tournament_id string, official_tournament_id bigint")
    rows = spark.createDataFrame([("atp", 1, "e"), ("wta", 1, "e")], "tour string, year int, id string")
    out = joins.attach_official_ids(rows, bridge, source="s", id_column="id")
    assert sorted((r.tour, r.official_tournament_id) for r in out.collect()) == [("atp", 10), ("wta", 20)]
    assert joins.bridge_duplicates(bridge).count() == 0
    with pytest.raises(Exception, match="several values"):
        joins.attach_official_ids(rows, bridge.drop("tour"), source="s", id_column="id").collect()
    df = spark.createDataFrame([("atp", "k", None), ("wta", "k", 5)], "tour string, key string, v int")
    lookup = spark.createDataFrame([("atp", "k", 1), ("wta", "k", 2)], "tour string, key string, v int")
    filled = joins.fill_or_override(df, lookup, ["tour", "key"], "v")
    assert sorted(tuple(r) for r in filled.select("tour", "v").collect()) == [("atp", 1), ("wta", 5)]


def test_corrections_merge_and_complain(spark):
    named = {"tour": "tour", "year": "year", "event_id": "id", "winner": "w", "loser": "l", "match_date": "day"}
    long = "c" * 120
    df = spark.createDataFrame([("t", 1, 1, "a", "b", None, "x", "y")], f"tour string, year bigint, id bigint, w string, l string, day date, {long} string, other string")
    def fix(name, values):
        return (name, "t", 1, 1, "a", "b", None, values)
    two = spark.createDataFrame([fix("f1", {"other": f"={long}"}), fix("f2", {long: "new"})], corrections.CORRECTION_SCHEMA)
    out = corrections.apply_corrections(df, two, named).collect()
    assert len(out) == 1 and out[0].other == "x" and out[0][long] == "new"
    assert {r.fix_id for r in corrections.wrong_corrections(df, two, named).collect()} == {"f1", "f2"}
    for values in ({"no such": "1"}, {"other": "=no such"}):
        bad = spark.createDataFrame([fix("f", values)], corrections.CORRECTION_SCHEMA)
        with pytest.raises(Exception, match="unknown columns"):
            corrections.apply_corrections(df, bad, named).collect()
