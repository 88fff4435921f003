import random
import unicodedata
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from matchwright.functions import dates, keys, names, numbers, scores, similarity, text

NAME_CASES = [
    ("Marlow", "Ines Marlow", True),
    ("Marlow Q.", "Ines Marlow", False),
    ("Van Der Berg S.", "Sanne Van Der Berg", True),
    ("Quill-Harte P.", "Petra Quill Harte", True),
    ("Quill-Harte P.", "Petra Quill", False),
    ("Mac Dara F.", "Fionn Macdara", True),
    ("Sørby Å.", "Åse Sorby", True),
    ("Łęcki W.", "Wanda Łęcki", True),
    ("Oduya Ch.", "Chidi Oduya", True),
    ("Oduya Ci.", "Chidi Oduya", False),
    ("Kern R.T.", "R T Kern", True),
    ("Kern R. T.", "Rosa Tilda Kern", True),
    ("Kern R.T.", "Rosa Kern", False),
    ("Kern R.T.", "Ro-Tilda Kern", False),
    ("Ines M.", "Ines Marlow", False),
    (None, "Ines Marlow", False),
    ("Marlow I.", None, False),
    (" ", "Ines Marlow", False),
]


def column(spark, values, expr, name="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {name}")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("v"))).collect()]


def test_names_compatible(spark):
    df = spark.createDataFrame(NAME_CASES, "a string, b string, want boolean")
    rows = df.select("a", "b", "want", names.names_compatible(F.col("a"), F.col("b")).alias("got"))
    assert [(r.a, r.b) for r in rows.collect() if r.got != r.want] == []


def test_names_conflict_needs_both_names(spark):
    df = spark.createDataFrame(
        [("Marlow I.", "Chidi Oduya"), (None, "Chidi Oduya"), (" ", "Chidi Oduya"), ("Oduya C.", "Chidi Oduya")],
        "a string, b string",
    )
    got = [r[0] for r in df.select(names.names_conflict(F.col("a"), F.col("b"))).collect()]
    assert got == [True, False, False, False]


@pytest.mark.parametrize(
    "name,want",
    [
        ("Marlow I.", ("marlow", "i")),
        ("Van Der Berg S.", ("van der berg", "s")),
        ("Oduya Ch.", ("oduya", "ch")),
        ("Kern R.T.", ("kern", "rt")),
        ("Kern R. T.", ("kern", "rt")),
        ("Ax Z.", ("ax", "z")),
        ("Q. R.", ("q", "r")),
    ],
)
def test_parse_abbreviated(spark, name, want):
    got = column(spark, [name], names.parse_abbreviated)[0]
    assert tuple(got) == want


def test_text(spark):
    assert column(spark, ["Queen's Club", "  Sao Paulo  ", "Roland Garros!", None], text.normalize_title) == [
        "queen s club", "sao paulo", "roland garros", "",
    ]
    assert column(spark, ["Đoković", "Łukasz", "Bjørn", "Weiß", "ﬁn"], text.normalize_name) == [
        "dokovic", "lukasz", "bjorn", "weiss", "fin",
    ]
    assert column(spark, ["Đoković"], text.normalize_title) == ["okovic"]
    assert column(spark, ["Roland Garros!", "  Sao Paulo  ", None], text.slug) == ["roland_garros", "sao_paulo", None]


def test_fold_equals_unicode_rule(spark):
    chars = [chr(p) for p in range(0xA1, 0x3400)] + ["é", "x½y", "ＡＢＣ", "㎏ and ﬃ"]
    chars += [chr(p) for p in [*range(0x1D400, 0x1D800), 0x1F100, 0x1F110, 0x2F800, 0x1F600]] + ["x𝐀𝐁y🄰"]

    def plain(v):
        return unicodedata.normalize("NFKD", v).encode("ascii", "ignore").decode("ascii")

    assert column(spark, chars, text.fold_accents) == [plain(c) for c in chars]


def test_keys(spark):
    row = spark.range(1).select(
        keys.event_key(F.lit(2024), F.lit(1), F.lit("Example"), F.lit("Example Open")).alias("e"),
        keys.place_title_key(F.lit("'s-Hertogenbosch"), F.lit("Libema Open")).alias("p"),
        keys.event_key(F.lit(2024), F.lit(1), F.lit(None).cast("string"), F.lit("x")).alias("n"),
    ).first()
    assert row.e == "2024_1_example_example_open"
    assert row.p == "s_hertogenbosch_libema_open"
    assert row.n is None
    day = F.to_date(F.lit("2024-01-15"))
    got = spark.range(1).select(
        keys.match_key(F.lit("2024_1_example_example_open"), day, F.lit("F"), F.lit("Player A."), F.lit("Player B."))
    ).first()[0]
    assert got == "2024_1_example_example_open_2024-01-15_F_player_a_player_b"
    ids = ["2025-0375", "2025-9900", None, "2016-M001", "2016-O16", "2010-W-INT-THA-01A-2010", "2025"]
    assert column(spark, ids, keys.permanent_id) == [375, 9900, None, None, None, None, None]
    assert column(spark, ids, keys.id_prefix_year) == [2025, 2025, None, 2016, 2016, 2010, 2025]


def test_dates(spark):
    got = column(spark, ["1/1/23", "2023-01-01", "12/31/2022", "20230101", "2023-01-01 00:00:00", "junk", None], dates.parse_date)
    assert [str(d) if d else None for d in got] == [
        "2023-01-01", "2023-01-01", "2022-12-31", "2023-01-01", "2023-01-01", None, None,
    ]
    assert str(column(spark, ["20260105.0"], dates.parse_compact_date)[0]) == "2026-01-05"
    df = spark.createDataFrame(
        [("2025-01-01", "2025-01-01"), ("2025-01-01", "2025-01-11"), ("2025-01-01", "2025-01-21"), ("2025-01-04", "2025-01-01"), (None, "2025-01-01")],
        "a string, b string",
    ).select(dates.date_closeness(F.to_date("a"), F.to_date("b")))
    assert [r[0] for r in df.collect()] == [1.0, 0.0, 0.0, 0.7, 0.0]


def test_numbers(spark):
    assert column(spark, ["301.0", " 7 ", "", "x", None, "NaN", "1.5"], numbers.to_long) == [301, 7, None, None, None, None, None]
    assert column(spark, [1.5, 0.8, None], lambda c: numbers.null_below(c, 1), "double") == [1.5, None, None]
    row = spark.range(1).select(
        numbers.row_mean([F.lit(1.0), F.lit(None).cast("double"), F.lit(2.0)]),
        numbers.row_mean([F.lit(None).cast("double")]),
        numbers.number_or(F.lit(" "), -1),
    ).first()
    assert tuple(row) == (1.5, None, -1.0)


def test_score_features(spark):
    rows = [
        ("6-2 6-3", 3, "A", "2021-01-01"),
        ("6-4 4-6 7-6(3)", 3, "G", "2023-01-01"),
        ("6-4 4-6 7-6(3)", 3, "G", "2021-01-01"),
        ("6-2 3-0 RET", 3, "A", "2021-01-01"),
        ("W/O", 3, "A", "2021-01-01"),
        (None, 3, "A", "2021-01-01"),
        ("", 3, "A", "2021-01-01"),
        ("3-6 6-3 (10-2)", 3, "A", "2019-01-01"),
        ("6-4 RET DEF", 3, "A", "2019-01-01"),
        ("7-6(10) 6-0", 5, "G", "2023-01-01"),
    ]
    df = spark.createDataFrame(rows, "score string, best_of int, tourney_level string, d string")
    out = scores.with_score_features(df.withColumn("tourney_date", F.to_date("d"))).collect()
    assert [r.match_status for r in out] == [
        "completed", "completed", "completed", "retired", "walkover", "completed", "completed", "completed", "defaulted", "completed",
    ]
    assert [r.sets_played for r in out] == [2, 3, 3, 2, 0, 0, 0, 2, 1, 2]
    assert (out[0].set1_winner, out[0].set1_loser, out[0].set2_loser, out[0].set3_winner) == (6, 2, 3, None)
    assert (out[1].set3_tiebreak_winner, out[1].set3_tiebreak_loser) == (10, 3)
    assert out[2].set3_tiebreak_winner == 7
    assert (out[3].set2_winner, out[3].set2_loser) == (3, 0)
    assert out[9].set1_tiebreak_winner == 12
    plain = scores.with_score_features(df.select("score").limit(3)).collect()
    assert plain[1].set3_tiebreak_winner == 7


def test_score_tokens(spark):
    got = column(spark, ["7-6(5)", "RET", "not-a-score", ""], scores.set_token)
    assert tuple(got[0]) == (7, 6, 5) and got[1:] == [None, None, None]


def test_oriented_score(spark):
    df = spark.createDataFrame([(6, 4, 0, 0, True), (6, 4, 7, 5, False)], "a int, b int, c int, d int, f boolean")
    sets = [(F.col("a"), F.col("b")), (F.col("c"), F.col("d"))]
    assert [r[0] for r in df.select(scores.oriented_score(sets, F.col("f"))).collect()] == ["6-4", "4-6 5-7"]


def test_similarity_and_its_filters_lose_nothing(spark):
    rng = random.Random(3)
    words = ["".join(rng.choice("abcd") for _ in range(rng.randint(0, 9))) for _ in range(60)]
    a = spark.createDataFrame([(w,) for w in sorted(set(words))], "a string")
    b = a.withColumnRenamed("a", "b")
    pairs = a.crossJoin(b).select("a", "b", similarity.sequence_ratio("a", "b").alias("r"), similarity.ratio_bound(F.col("a"), F.col("b")).alias("bound"))
    rows = pairs.collect()
    assert all(r.r == SequenceMatcher(None, r.a, r.b).ratio() and r.r <= r.bound + 1e-12 for r in rows)
    for least in (0.8, 0.9, 1.0, 0.6):
        want = {(r.a, r.b) for r in rows if r.r >= least}
        left = a.select("a", F.explode(similarity.probe_keys(F.col("a"), least)).alias("k"))
        right = b.select("b", F.explode(similarity.piece_keys(F.col("b"), least)).alias("k"))
        found = {(r.a, r.b) for r in left.join(right, "k").select("a", "b").distinct().collect()}
        assert want <= found
        assert len(found) < len(rows)
