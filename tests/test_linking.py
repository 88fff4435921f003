import datetime as dt

import pytest
from pyspark.sql import functions as F

from matchwright.operators import joins, linking

BRIDGE = [
    (520, 2025, "tennis_data_uk", "2025_29_paris_french_open"),
    (520, 2025, "sackmann", "2025-520"),
    (999, 2025, "tennis_data_uk", "2025_1_other_event"),
    (999, 2025, "sackmann", "2025-999"),
    (904, 2014, "tennis_data_uk", "2014_32_london_wimbledon"),
    (904, 2014, "sackmann", "2014-W-SL-GBR-01A-2014"),
]
FEED = "source string, tour string, year bigint, source_event_key string, match_date date, winner_name string, loser_name string, winner_rank bigint, loser_rank bigint, winner_rank_points double, loser_rank_points double, round string, source_match_key string"
ARCH = "tourney_id string, tourney_name string, match_num bigint, winner_id bigint, loser_id bigint, winner_name string, loser_name string, winner_rank bigint, loser_rank bigint, winner_rank_points double, loser_rank_points double, round string, source_year bigint, tour string"


def feed_row(**k):
    base = dict(source="tennis_data_uk", tour="atp", year=2025, source_event_key="2025_29_paris_french_open", match_date=dt.date(2025, 6, 1), winner_name="Fritz T.", loser_name="Nava E.", winner_rank=1, loser_rank=5, winner_rank_points=10000.0, loser_rank_points=3000.0, round="F", source_match_key="uk_1")
    return tuple({**base, **k}.values())


def arch_row(**k):
    base = dict(tourney_id="2025-520", tourney_name="Roland Garros", match_num=300, winner_id=111, loser_id=222, winner_name="Taylor Fritz", loser_name="Emilio Nava", winner_rank=1, loser_rank=5, winner_rank_points=10000.0, loser_rank_points=3000.0, round="F", source_year=2025, tour="atp")
    return tuple({**base, **k}.values())


def frames(spark, feed, archive):
    bridge = spark.createDataFrame(BRIDGE, "official_tournament_id bigint, year bigint, source string, source_tournament_id string")
    f = spark.createDataFrame(feed, FEED)
    a = linking.add_canonical_key(spark.createDataFrame(archive, ARCH))
    f = joins.attach_official_ids(f, bridge, source="tennis_data_uk", id_column="source_event_key")
    a = joins.attach_official_ids(a, bridge, source="sackmann", id_column="tourney_id", year_column="source_year")
    return f, a.withColumn("year", F.col("source_year"))


def run(spark, feed, archive, manual=None):
    f, a = frames(spark, feed, archive)
    m = None
    if manual is not None:
        m = spark.createDataFrame(manual, "year bigint, source_match_key string, canonical_match_key string")
    return linking.link(f, a, m)


def one_pass(spark, feed, archive):
    f, a = frames(spark, feed, archive)
    blocks = linking.rank_blocks(f, a)
    acc = linking.rank_links(blocks).collect()
    amb = linking.rank_pairs(linking.rank_ambiguous(f, blocks), a).count()
    return acc, amb


def second_pass(spark, feed, archive):
    f, a = frames(spark, feed, archive)
    g = linking.name_groups(f, a)
    return linking.name_links(g).collect(), linking.name_candidates(f, g).collect()


def test_unique_rank_pair(spark):
    acc, amb = one_pass(spark, [feed_row()], [arch_row()])
    assert amb == 0 and len(acc) == 1
    r = acc[0]
    assert (r.canonical_match_key, r.winner_id, r.loser_id, r.match_method) == ("2025-520_300", 111, 222, "tournament_rank_unique")
    assert r.round_agrees and r.winner_rank_points_diff == 0 and r.loser_rank_points_diff == 0


def test_ambiguous_either_side(spark):
    assert one_pass(spark, [feed_row()], [arch_row(), arch_row(match_num=301)])[1] == 2
    acc, amb = one_pass(spark, [feed_row(), feed_row(source_match_key="uk_2")], [arch_row()])
    assert (acc, amb) == ([], 2)


def test_no_mapping_or_rank_or_other_event(spark):
    for f, a in (
        ([feed_row(source_event_key="nope")], [arch_row()]),
        ([feed_row(winner_rank=None)], [arch_row()]),
        ([feed_row()], [arch_row(tourney_id="2025-999")]),
    ):
        assert one_pass(spark, f, a) == ([], 0)


@pytest.mark.parametrize(
    "change,flag,winner_agrees",
    [(dict(winner_rank=None), "missing_rank", None), (dict(loser_rank=968), "rank_mismatch", True), ({}, None, True)],
)
def test_name_pass_flags(spark, change, flag, winner_agrees):
    acc, _ = second_pass(spark, [feed_row(**change)], [arch_row()])
    assert (acc[0].data_quality_flag, acc[0].winner_rank_agrees) == (flag, winner_agrees)
    assert acc[0].match_method == "tournament_round_name_pair"


def test_name_pass_two_candidates(spark):
    acc, cand = second_pass(spark, [feed_row()], [arch_row(), arch_row(match_num=301)])
    assert acc == [] and cand[0].source_candidate_count == 2


def test_name_pass_round_and_orientation(spark):
    assert second_pass(spark, [feed_row(round="SF")], [arch_row()]) == ([], [])
    assert second_pass(spark, [feed_row()], [arch_row(winner_name="Emilio Nava", loser_name="Taylor Fritz")]) == ([], [])
    acc, _ = second_pass(spark, [feed_row(round=None)], [arch_row(round=None)])
    assert len(acc) == 1


def test_both_passes(spark):
    feed = [feed_row(), feed_row(source_match_key="uk_2", winner_name="Munar J.", loser_name="Martin D.", winner_rank=None, round="R64")]
    arch = [arch_row(), arch_row(match_num=301, winner_name="Jaume Munar", loser_name="Damir Martin", winner_rank=60, loser_rank=70, round="R64")]
    got = {r.source_match_key: r.match_method for r in run(spark, feed, arch).accepted.collect()}
    assert got == {"uk_1": "tournament_rank_unique", "uk_2": "tournament_round_name_pair"}


def test_rank_ambiguity_saved_by_names(spark):
    out = run(spark, [feed_row()], [arch_row(), arch_row(match_num=301, round="SF", winner_name="Other Player", loser_name="Some Body")])
    assert [r.canonical_match_key for r in out.accepted.collect()] == ["2025-520_300"]
    assert out.ambiguous.count() == 0 and out.status.first().linkage_status == "linked"


def test_still_ambiguous_keeps_all_pairs(spark):
    out = run(spark, [feed_row()], [arch_row(), arch_row(match_num=301)])
    assert out.accepted.count() == 0
    assert out.status.first().linkage_status == "ambiguous"
    pairs = {(r.found_in_pass, r.canonical_match_key) for r in out.pairs().collect()}
    assert pairs == {(1, "2025-520_300"), (1, "2025-520_301"), (2, "2025-520_300"), (2, "2025-520_301")}


WIMBLEDON_FEED = [
    feed_row(tour="wta", year=2014, source_event_key="2014_32_london_wimbledon", winner_name="Halep S.", loser_name="Bencic B.", winner_rank=3, loser_rank=72, winner_rank_points=6280.0, loser_rank_points=773.0, round="R32", source_match_key="a"),
    feed_row(tour="wta", year=2014, source_event_key="2014_32_london_wimbledon", winner_name="Halep S.", loser_name="Diyas Z.", winner_rank=3, loser_rank=71, winner_rank_points=6280.0, loser_rank_points=781.0, round="R16", source_match_key="b"),
]


def wimbledon(**k):
    return arch_row(**{**dict(tourney_id="2014-W-SL-GBR-01A-2014", tour="wta", source_year=2014, winner_name="Simona Halep", winner_id=201594, winner_rank=3), **k})


WIMBLEDON_ARCH = [
    wimbledon(match_num=101, loser_id=202505, loser_name="Belinda Bencic", loser_rank=71, round="R32"),
    wimbledon(match_num=115, loser_id=201610, loser_name="Zarina Diyas", loser_rank=72, round="R16"),
]


def test_swapped_ranks_regression(spark):
    assert one_pass(spark, WIMBLEDON_FEED, WIMBLEDON_ARCH) == ([], 0)
    out = run(spark, WIMBLEDON_FEED, WIMBLEDON_ARCH)
    got = {r.source_match_key: (r.canonical_match_key[-3:], r.data_quality_flag) for r in out.accepted.collect()}
    assert got == {"a": ("101", "rank_mismatch"), "b": ("115", "rank_mismatch")}


def test_contradiction_needs_round_and_name(spark):
    assert len(one_pass(spark, [feed_row(round="SF")], [arch_row()])[0]) == 1
    assert one_pass(spark, [feed_row(round="SF", loser_name="Diyas Z.")], [arch_row()])[0] == []
    assert len(one_pass(spark, [feed_row(round=None, loser_name="Diyas Z.")], [arch_row()])[0]) == 1
    assert len(one_pass(spark, [feed_row(round="SF", loser_name=None, winner_name=" ")], [arch_row()])[0]) == 1


def test_manual_link_wins(spark):
    out = run(spark, [feed_row()], [arch_row(), arch_row(match_num=301)], [(2025, "uk_1", "2025-520_300"), (2024, "x", "y")])
    rows = out.accepted.collect()
    assert [(r.source_match_key, r.match_method, r.round_agrees, r.source_candidate_count) for r in rows] == [("uk_1", "manual_override", None, None)]
    assert out.ambiguous.count() == 0 and out.unmatched.count() == 0
    f, a = frames(spark, [feed_row()], [arch_row()])
    bad = spark.createDataFrame([(2025, "uk_9", "2025-520_300"), (2025, "uk_1", "2025-520_300"), (2024, "z", "q")], "year bigint, source_match_key string, canonical_match_key string")
    got = {(r.match_key, r.problem) for r in linking.manual_problems(bad, f, a).collect()}
    assert got == {("uk_9", "unknown"), ("2025-520_300", "named twice")}


def test_outputs(spark):
    feed = [feed_row(), feed_row(source_match_key="uk_2", winner_name="Munar J.", loser_name="Martin D.", winner_rank=None, round="R64"), feed_row(source_match_key="uk_3", source_event_key="nope"), feed_row(source_match_key="uk_4", winner_rank=88, loser_rank=None, winner_name="No Body", round="R16")]
    arch = [arch_row(), arch_row(match_num=301, winner_name="Jaume Munar", loser_name="Damir Martin", winner_rank=60, loser_rank=70, round="R64")]
    out = run(spark, feed, arch)
    s = linking.linkage_summary(out.status, out.archive).first()
    assert (s.uk_total_matches, s.linked_matches, s.linked_manual, s.linked_pass_1, s.linked_pass_2, s.ambiguous_matches, s.unmatched_matches, s.coverage_pct) == (4, 2, 0, 1, 1, 0, 2, 50.0)
    assert {r.source_match_key: r.unmatched_reason for r in out.unmatched.collect()} == {"uk_3": "missing_tournament_mapping", "uk_4": "no_rank_candidate"}
    enriched = linking.enrich(out.feed.drop("official_tournament_id"), out.archive, out.accepted)
    assert enriched.columns[-12:] == list(linking.ENRICHED_BLOCK)
    rows = {r.source_match_key: r for r in enriched.collect()}
    assert len(rows) == 4 and rows["uk_1"].canonical_tourney_name == "Roland Garros" and rows["uk_3"].canonical_match_key is None
    assert linking.crosswalk(out.accepted).columns == list(linking.CROSSWALK_COLUMNS)


def test_collision_key(spark):
    df = spark.createDataFrame([("2024-1", 5, "RR"), ("2024-1", 5, "F"), ("2024-1", 6, "F")], "tourney_id string, match_num int, round string")
    assert {r.canonical_match_key for r in linking.add_canonical_key(df).collect()} == {"2024-1_5_RR", "2024-1_5_F", "2024-1_6"}


def test_hot_block_stays_linear(spark):
    feed = [feed_row(source_match_key=f"u{i}") for i in range(300)]
    arch = [arch_row(match_num=i) for i in range(300)]
    out = run(spark, feed, arch)
    assert linking.rank_blocks(out.feed, out.archive).count() == 1
    assert linking.name_groups(out.feed, out.archive).count() == 1
    s = linking.linkage_summary(out.status, out.archive).first()
    assert (s.ambiguous_matches, s.linked_matches) == (300, 0)
