import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from matchwright.contracts import archive as archive_contract
from matchwright.contracts import feed as feed_contract
from matchwright.operators import corrections
from matchwright.plans import cleaning, curated, linking, mapping, tournaments
from matchwright.sources import archive, catalog, feed, files, sinks
from matchwright.streaming import refresh

ATP_HEADER = "ATP,Location,Tournament,Date,Series,Court,Surface,Round,Best of,Winner,Loser,WRank,LRank,WPts,LPts,W1,L1,W2,L2,W3,L3,Wsets,Lsets,Comment,B365W,B365L,AvgW,AvgL"


def atp_line(i=1, rnd="The Final", w="Fritz T.", l="Nava E.", date="1/7/24", comment="Completed", w1=6, surface="Hard", avg="1.5", loc="Adelaide␠", ranks="10,20.0"):
    return f"{i},{loc.replace('␠', ' ')},Adelaide International,{date},ATP250,Outdoor,{surface},{rnd},5,{w},{l},{ranks},500,400,{w1},2,6,3,,,2,0,{comment},{avg},0.8,1.6,2.2"


def write(path, header, lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join([header, *lines]) + "\n")
    return str(path)


@pytest.fixture
def season(tmp_path):
    lines = [atp_line(), atp_line(rnd="Semifinals", l="Bu Y.", date="2024-01-06", ranks="11,21"), atp_line(rnd="1st Round", w="Nava E.", l="Wu Y.", comment="Sched", avg="NA", ranks="12,22")]
    return write(tmp_path / "atp_2024.csv", ATP_HEADER, lines)


def test_clean_feed(spark, season):
    raw = feed.scan_raw(spark, {("atp", 2024): season})
    assert dict(raw.dtypes)["WRank"] == "bigint" and dict(raw.dtypes)["AvgW"] == "double"
    out = cleaning.clean(cleaning.fix_raw(raw, "atp"), "atp")
    assert out.columns == list(feed_contract.CLEAN_COLUMNS) and len(out.columns) == 42
    rows = {r["round"]: r for r in out.collect()}
    f = rows["F"]
    assert f.source_event_key == "2024_1_adelaide_adelaide_international"
    assert f.source_match_key == "2024_1_adelaide_adelaide_international_2024-01-07_F_fritz_t_nava_e"
    assert (f.best_of, f.series, f.surface, f.is_outdoor, f.players_remaining, f.loser_rank) == (3, "atp_250", "hard", True, 2, 20)
    assert (f.odds_b365_winner, f.odds_b365_loser, f.odds_pinnacle_winner, f.location) == (1.5, None, None, "Adelaide")
    assert rows["R16"].match_status == "completed" and rows["R16"].odds_b365_winner is None


def test_bad_season_is_held_back(spark, season, tmp_path):
    bad = write(tmp_path / "atp_2023.csv", ATP_HEADER, [atp_line(date="2023-01-07", surface="Ice")])
    raw = {"atp": feed.scan_raw(spark, {("atp", 2024): season, ("atp", 2023): bad})}
    run = cleaning.clean_seasons(spark, raw, str(tmp_path / "clean"))
    assert {(r.year, r.success, r.rows) for r in run.seasons.collect()} == {(2024, True, 3), (2023, False, 1)}
    assert [r.rule for r in run.violations.collect()] == ["unexpected_surface"]
    assert feed.scan_clean(spark, str(tmp_path / "clean"), "atp").select("year").distinct().collect()[0].year == 2024
    assert {r.metric: r.value for r in run.report.collect()}["rows"] == 3.0
    with pytest.raises(ValueError, match="unexpected_surface"):
        cleaning.clean_seasons(spark, raw, str(tmp_path / "clean2"), fail_fast=True)


def test_report_replaces_seasons(spark, tmp_path):
    root, s = str(tmp_path / "report"), "tour string, year int, metric string, value double"
    cleaning.update_report(spark.createDataFrame([("atp", 2023, "rows", 1.0), ("atp", 2024, "rows", 2.0), ("atp", 2024, "status_count_typo", 1.0)], s), root)
    out = cleaning.update_report(spark.createDataFrame([("atp", 2024, "rows", 3.0)], s), root)
    assert sorted((r.year, r.metric, r.value) for r in out.collect()) == [(2023, "rows", 1.0), (2024, "rows", 3.0)]


def test_fix_saves_season(spark, tmp_path):
    bad = write(tmp_path / "atp_2024.csv", ATP_HEADER, [atp_line(surface="Ice")])
    raw = {"atp": feed.scan_raw(spark, {("atp", 2024): bad})}
    row = ("f", "atp", 2024, 1, "Fritz T.", "Nava E.", dt.date(2024, 1, 7), {"Surface": "Hard"})
    fixes = spark.createDataFrame([row], corrections.CORRECTION_SCHEMA)
    run = cleaning.clean_seasons(spark, raw, str(tmp_path / "clean"), fixes=fixes)
    assert run.violations.count() == 0
    off = spark.createDataFrame([(*row[:4], "Nobody", *row[5:])], corrections.CORRECTION_SCHEMA)
    run = cleaning.clean_seasons(spark, raw, str(tmp_path / "clean"), fixes=off)
    assert {r.rule for r in run.violations.collect()} == {"unexpected_surface", "correction_not_on_one_row"}


def test_wta_typos_and_swap(spark, tmp_path):
    header = ATP_HEADER.replace("ATP,", "WTA,").replace("Series", "Tier")
    lines = [
        "36,Warsaw,Poland Open,7/24/2023,WTA250,Outdoor,Clay,The Final,3,A B.,C D.,1,2,332.25,1,6,1,6,1,,,2,0,Completed,,,,",
        "1,X,Y,2023-01-02,WTA263,Outdoor,Greenset,Third Place,5,A B.,C D.,1,2,1,1,6,1,,,,,1,0,Walkoer,,,,",
    ]
    path = write(tmp_path / "wta.csv", header, lines)
    out = {r.uk_tournament_id: r for r in cleaning.clean(feed.scan_raw(spark, {("wta", 2023): path}), "wta").collect()}
    assert (out[36].surface, out[36].winner_rank_points, out[36].series) == ("hard", 332.25, "wta_250")
    assert (out[1].series, out[1].match_status, out[1].surface, out[1].best_of, out[1]["round"], out[1].players_remaining) == ("wta_250", "walkover", "hard", 3, "BR", 4)
    with pytest.raises(ValueError, match="wrong data set"):
        feed.scan_raw(spark, {("atp", 2023): path})
    a = [atp_line(i=2, loc="Auckland", date="2020-01-13"), atp_line(i=3, loc="Adelaide", date="2020-01-13")]
    raw = feed.scan_raw(spark, {("atp", 2020): write(tmp_path / "a.csv", ATP_HEADER, a)})
    got = {(r.ATP, r.Location) for r in cleaning.fix_raw(raw, "atp").collect()}
    assert got == {(3, "Adelaide"), (2, "Auckland")}


def archive_file(tmp_path, tour, year, rows, columns=None):
    columns = columns or archive_contract.layout("singles")
    lines = [",".join(str(r.get(c, "")) for c in columns) for r in rows]
    return write(tmp_path / f"{tour}_matches_{year}.csv", ",".join(columns), lines)


MATCH = dict(tourney_id="2024-0301", tourney_name="Adelaide", surface="Hard", draw_size=32, tourney_level="A", tourney_date=20240101, match_num=300, winner_id=1, winner_name="Taylor Fritz", winner_rank="10", winner_rank_points=500, loser_id=2, loser_name="Emilio Nava", loser_rank="20.0", loser_rank_points=400, score="6-2 6-3", best_of=3, round="F", winner_age=25.5, w_ace=3)


def test_archive_scan(spark, tmp_path):
    assert len(archive_contract.layout("singles")) == 49 and len(archive_contract.layout("doubles")) == 65
    shuffled = tuple(reversed(archive_contract.layout("singles")))
    archive_file(tmp_path, "atp", 2024, [MATCH, {**MATCH, "match_num": 299, "round": "SF", "loser_name": "Yunchaokete Bu"}])
    archive_file(tmp_path, "atp", 2023, [{**MATCH, "tourney_id": "2023-1"}, {**MATCH, "tourney_id": "2023-1", "round": "RR"}], shuffled)
    df = archive.scan_archive(spark, str(tmp_path), "atp", archive.year_range(2023, 2024))
    keys = {r.canonical_match_key for r in df.collect()}
    assert keys == {"2024-0301_300", "2024-0301_299", "2023-1_300_F", "2023-1_300_RR"}
    r = df.where("canonical_match_key = '2024-0301_300'").first()
    assert (r.source_year, r.tour, r.match_type, r.match_level, r.loser_rank, r.winner_age, str(r.tourney_date)) == (2024, "atp", "singles", "main", 20, 25.5, "2024-01-01")
    with pytest.raises(ValueError):
        archive.year_range(2024, 2023)
    write(tmp_path / "atp_players.csv", "player_id,name_first", ["1,Taylor"])
    write(tmp_path / "wta_rankings_current.csv", "ranking_date,rank,player", ["20240101,1,7"])
    assert archive.scan_people(spark, str(tmp_path), "atp").first().player_id == 1
    assert archive.scan_rankings(spark, str(tmp_path), "wta").first().player == 7


def test_doubles_scan(spark, tmp_path):
    columns = archive_contract.layout("doubles")
    row = dict(tourney_id="2019-1", match_num=7, tourney_date=20190101, winner1_id=1, winner2_id=2, loser1_rank="9.0", loser2_age="30.5", score="3-6 6-3 (10-2)", best_of=3)
    write(tmp_path / "atp_matches_doubles_2019.csv", ",".join(columns), [",".join(str(row.get(c, "")) for c in columns)])
    df = archive.scan_archive(spark, str(tmp_path), "atp", [2019], "doubles")
    r = df.first()
    assert "match_level" not in df.columns
    assert (r.match_type, r.canonical_match_key, r.winner2_id, r.loser1_rank, r.loser2_age, r.source_year) == ("doubles", "2019-1_7", 2, 9, 30.5, 2019)


def test_catalog_scan(spark, tmp_path):
    entry = dict(tournamentGroup=dict(id=609, name="INDIAN WELLS", level="x"), level="WTA 1000", title="T", year=2025, startDate="2025-03-05", endDate="2025-03-16", surface="Hard", inOutdoor="O", city="C", country="US", singlesDrawSize=96, doublesDrawSize=32, prizeMoney=1, prizeMoneyCurrency="USD", status="past", winners=[{"singles": None}, {"singles": {"player": {"fullName": "Mirra Andreeva"}}}])
    other = {**entry, "tournamentGroup": dict(id=7, name="x", level="x"), "level": "ITF", "winners": []}
    (tmp_path / "p.json").write_text(json.dumps({"content": [entry, entry, other]}))
    df = catalog.scan_catalog(spark, str(tmp_path), exclude_levels="ITF")
    assert df.count() == 2
    assert catalog.scan_catalog(spark, str(tmp_path)).where("tournament_group_id = 7").first().singles_champion is None
    rows = catalog.catalog_table(df).collect()
    assert [(r.tour, r.official_tournament_id, r.singles_champion, str(r.start_date)) for r in rows] == [("wta", 609, "Mirra Andreeva", "2025-03-05")]


def test_tables(spark, tmp_path):
    schema = "k string, v int"
    assert files.read_table(spark, str(tmp_path / "none"), schema).count() == 0
    root = str(tmp_path / "t")
    assert sinks.current(spark, root, schema).count() == 0
    for v in (1, 2):
        old = sinks.current(spark, root, schema)
        sinks.store(old.unionByName(spark.createDataFrame([("a", v)], schema)), root, ["k"])
    assert sinks.current(spark, root, schema).count() == 2
    new = spark.createDataFrame([("b", 3)], schema)
    sinks.replace_partitions(new, root, ["k"], [("a",), ("b",), ("c",)])
    assert [tuple(r) for r in sinks.current(spark, root, schema).collect()] == [("b", 3)]
    part = str(tmp_path / "p")
    for rows in ([("atp", 2020, 1), ("atp", 2021, 1)], [("atp", 2021, 2), ("atp", 2021, 3)]):
        sinks.overwrite_partitions(spark.createDataFrame(rows, "tour string, year int, v int"), part, ["tour", "year"])
    assert sorted((r.year, r.v) for r in spark.read.parquet(part).collect()) == [(2020, 1), (2021, 2), (2021, 3)]
    assert files.seasons_on_file(spark.read.parquet(part)).count() == 2


def test_from_files_to_curated_matches(spark, season, tmp_path):
    root = str(tmp_path / "out")
    cleaning.clean_seasons(spark, {"atp": feed.scan_raw(spark, {("atp", 2024): season})}, f"{root}/clean")
    matches = feed.scan_clean(spark, f"{root}/clean")
    archive_file(tmp_path, "atp", 2024, [MATCH, {**MATCH, "match_num": 299, "round": "SF", "loser_name": "Yunchaokete Bu", "loser_rank": ""}])
    history = archive.scan_archive(spark, str(tmp_path), "atp", [2024])
    table, audit = tournaments.feed_tournaments(matches)
    other, _ = tournaments.archive_tournaments(history)
    assert audit.count() == 0
    t = table.first()
    assert (t.champion, t.num_players, t.num_completed_matches, t.num_cancelled_matches, t.location_tournament_key) == ("Fritz T.", 4, 3, 0, "adelaide_adelaide_international")
    o = other.first()
    assert (o.year, o.tourney_number, o.surface, o.champion, o.num_matches) == (2024, "0301", "hard", "Taylor Fritz", 2)
    manual = spark.createDataFrame([], mapping.MANUAL)
    for _ in range(2):
        mapped = mapping.map_tournaments(spark, table, other, f"{root}/map", manual=manual)
    assert [(r.location_key, r.official_tournament_id) for r in mapped.crosswalk.collect()] == [("adelaide", 301)]
    assert mapped.source_links.count() == 2 and mapped.conflicts.count() == 0
    summary = linking.link_seasons(spark, matches, history, mapped.source_links, f"{root}/linked").collect()
    s = summary[0]
    assert (s.uk_total_matches, s.sackmann_total_matches, s.linked_pass_1, s.linked_pass_2, s.unmatched_matches) == (3, 2, 1, 1, 1)
    assert [r.unmatched_reason for r in spark.read.parquet(f"{root}/linked/unmatched").collect()] == ["no_name_pair_candidate"]
    enriched = spark.read.parquet(f"{root}/linked/enriched_matches")
    assert enriched.count() == 3
    data = curated.curated_matches(history, enriched, in_order=True)
    rows = data.collect()
    assert [(r.match_num, r.set1_winner, r.odds_avg_winner, r.match_method) for r in rows] == [(299, 6, 1.6, "tournament_round_name_pair"), (300, 6, 1.6, "tournament_rank_unique")]
    curated.export(data, f"{root}/export", "csv")
    assert spark.read.option("header", True).csv(f"{root}/export").count() == 2
    assert linking.review(linking.summaries(spark, f"{root}/linked"), [2024]).count() == 1
    wanted = spark.createDataFrame([("atp", 2024), ("atp", 2025)], "tour string, year int")
    assert [r.year for r in linking.missing_seasons(linking.summaries(spark, f"{root}/linked"), wanted).collect()] == [2025]


def test_refresh(spark, season, tmp_path):
    landing, root = tmp_path / "land", str(tmp_path / "store")
    write(landing / "tour=atp" / "year=2024" / "a.csv", ATP_HEADER, [atp_line()])
    first = refresh.refresh_seasons(spark, str(landing), root)
    assert first.seasons == [("atp", 2024, 1, True)] and not first.needs_attention
    assert refresh.refresh_seasons(spark, str(landing), root).seasons == []
    write(landing / "tour=atp" / "year=2023" / "a.csv", ATP_HEADER, [atp_line(date="2023-01-07", surface="Ice")])
    again = refresh.refresh_seasons(spark, str(landing), root, always=[("atp", 2024)])
    assert again.seasons == [("atp", 2023, 1, False), ("atp", 2024, 1, True)] and again.needs_attention
    assert sinks.current(spark, f"{root}/tournaments", "tour string, year bigint, champion string").collect()[0].champion == "Fritz T."


def test_wrong_file_holds_back_its_own_season(spark, tmp_path):
    landing, root = tmp_path / "landing", str(tmp_path / "out")
    write(landing / "tour=atp" / "year=2024" / "a.csv", ATP_HEADER, [atp_line()])
    wta = ATP_HEADER.replace("ATP,", "WTA,").replace("Series", "Tier")
    write(landing / "tour=atp" / "year=2025" / "a.csv", wta, [atp_line()])
    write(landing / "tour=atp" / "year=2023" / "a.csv", ATP_HEADER, [atp_line(date="2023-01-07"), "1,too,short"])
    write(landing / "tour=atp" / "year=2022" / "a.csv", ATP_HEADER.replace("Court,", ""), [atp_line()])
    (landing / "tour=atp" / "year=2021").mkdir()
    (landing / "tour=atp" / "year=2021" / "a.csv").write_text("\n")
    done = refresh.refresh_seasons(spark, str(landing), root)
    assert done.needs_attention
    assert [(y, ok) for _, y, _, ok in done.seasons] == [(2021, False), (2022, False), (2023, False), (2024, True), (2025, False)]
    rules = {(r.year, r.rule) for r in spark.read.parquet(f"{root}/violations").collect()}
    assert {(2021, "empty_file"), (2022, "missing_column_Court"), (2023, "ragged_line"), (2025, "wrong_data_set")} <= rules
    assert [r.year for r in feed.scan_clean(spark, f"{root}/clean").select("year").collect()] == [2024]
    assert {r.year for r in spark.read.parquet(f"{root}/report").select("year").collect()} == {2024}
    write(landing / "tour=atp" / "year=2025" / "b.csv", ATP_HEADER + ",New", [atp_line(date="2025-01-07") + ",1"])
    write(landing / "tour=atp" / "year=2024" / "c.csv", ATP_HEADER + ",New", [atp_line() + ",1"])
    again = refresh.refresh_seasons(spark, str(landing), root)
    assert [(y, ok) for _, y, _, ok in again.seasons] == [(2024, True), (2025, True)]
    drift = {(r.year, r["column"], r.change) for r in spark.read.parquet(f"{root}/drift").collect()}
    assert (2024, "New", "added") in drift and (2025, "WTA", "removed") in drift
    assert not [r for r in spark.read.parquet(f"{root}/violations").collect() if r.year == 2025]


def test_ragged_lines_are_kept_and_counted(spark, tmp_path):
    path = write(tmp_path / "x.csv", "a,b", ["1,2", "3,4,5", "6"])
    raw = files.read_text_csv(spark, [path])
    assert {r[files.RAGGED] for r in raw.collect()} == {None, "3,4,5", "6"}
    assert [r.lines for r in files.ragged_lines(raw).collect()] == [2]
    with pytest.raises(Exception, match="ragged line"):
        files.reject_ragged(raw).collect()


def test_output_gates(spark):
    s = "tour string, year bigint, source_match_key string, canonical_match_key string, winner_id bigint, loser_id bigint"
    links = spark.createDataFrame([("t", 1, "a", "x", 1, 2), ("t", 1, "b", "x", 1, 2), ("t", 1, "c", "y", 9, 9)], s)
    truth = spark.createDataFrame([("t", 1, "x", 1, 2), ("t", 1, "y", 3, 4)], "tour string, year bigint, canonical_match_key string, winner_id bigint, loser_id bigint")
    own = spark.createDataFrame([("t", 1, k) for k in "abcd"], "tour string, year bigint, source_match_key string")
    status = own.where("source_match_key <> 'd'").withColumn("linkage_status", F.lit("linked"))
    found = {r.problem for r in linking.output_problems(own, truth, links, status, own.where("source_match_key <> 'a'")).collect()}
    assert found == {"canonical_match_key linked twice", "ids of another match", "records without exactly one status", "enriched rows lost or added"}
