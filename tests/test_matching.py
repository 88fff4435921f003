"""Gestalt ratios, greedy choice and refilled lists against plain walks."""

import datetime as dt
import hashlib
import math
import random
from difflib import SequenceMatcher

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from matchwright.functions import gestalt
from matchwright.operators import candidates, matching

PAIRS = "b int, l_id string, r_id string, score double"


def walk(rows):
    """The choice by a walk down (block, l, r, score), all pairs sorted."""
    tie = lambda r: hashlib.md5(f"{r[1]}|{r[2]}".encode()).hexdigest()
    gone, out = set(), set()
    for b, l, r, s in sorted(rows, key=lambda x: (-x[3], tie(x), x[1], x[2])):
        if ("l", b, l) not in gone and ("r", b, r) not in gone:
            gone |= {("l", b, l), ("r", b, r)}
            out.add((b, l, r))
    return out


def chosen(df):
    return {(r.b, r.l_id, r.r_id) for r in df.collect()}


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.text("abcé日", max_size=12), st.text("abcé日", max_size=12)), max_size=20))
def test_ratios_like_difflib(pairs):
    left, right = [a for a, _ in pairs], [b for _, b in pairs]
    assert gestalt.ratios(left, right).tolist() == [SequenceMatcher(None, a, b).ratio() for a, b in pairs]


def test_ratios_of_long_and_various_texts():
    pick = random.Random(2)
    text = lambda: "".join(pick.choice("abcdefgh ") for _ in range(pick.choice([0, 1, 30, 198, 199, 200, 201, 400])))
    left, right = [text() for _ in range(150)], [text() for _ in range(150)]
    left += ["".join(map(chr, range(1000, 1150))), "same", ""]
    right += ["".join(map(chr, range(1100, 1280))), "same", ""]
    assert gestalt.ratios(left, right).tolist() == [SequenceMatcher(None, a, b).ratio() for a, b in zip(left, right, strict=True)]


@pytest.mark.parametrize("walk_rows", [matching.WALK_ROWS, 0])
def test_choice_equals_the_walk(spark, walk_rows):
    rng = random.Random(5)
    rows = [
        (b, f"l{l}", f"r{r}", rng.choice([0.5, 0.6, 0.7, 0.9, rng.random()]))
        for b in range(12)
        for l in range(rng.randint(1, 9))
        for r in range(rng.randint(1, 9))
        if rng.random() < 0.8
    ]
    assert chosen(matching.assign(spark.createDataFrame(rows, PAIRS), ["b"], walk_rows=walk_rows)) == walk(rows)


def chain(n):
    """Pairs of which each competes with the next, by turns on the left and on the right."""
    return [(1, f"l{i // 2}", f"r{(i + 1) // 2}", 0.5 + i / (4 * n)) for i in range(n)]


@pytest.mark.parametrize("n", [48, 1000])
def test_chain_of_rising_scores(spark, monkeypatch, n):
    steps = []
    stage = matching.stage
    monkeypatch.setattr(matching, "stage", lambda df, name: (steps.append(name), stage(df, name))[1])
    rows = chain(n)
    df = spark.createDataFrame(rows, PAIRS)
    assert chosen(matching.assign(df, ["b"], walk_rows=0)) == walk(rows)
    assert steps.count("chains") + steps.count("open-pairs") - 1 <= 2 * math.log2(n)
    assert chosen(matching.assign(df, ["b"])) == walk(rows)


EVENT = "b int, id string, name string, other string, surface string, start_date date"


def events(rng, prefix, n, days, block=1):
    words = ["open", "masters", "cup", "paris", "rome", "lyon", "classic", "indoor", "ladies", "royal"]
    text = lambda: " ".join(rng.sample(words, rng.randint(1, 3)))
    first = dt.date(2025, 1, 1)
    return [
        (block, f"{prefix}{i}", text(), text(), rng.choice(["hard", "hard", "clay", None]), first + dt.timedelta(days=rng.randrange(days)))
        for i in range(n)
    ]


def all_pairs(left, right, floor):
    out = []
    for b, l, n1, n2, surface, day in left:
        for c, r, m1, _, other, when in right:
            if b == c:
                name = max(SequenceMatcher(None, n, m1).ratio() for n in (n1, n2))
                near = max(0.0, 1 - abs((day - when).days) / 10)
                score = 0.5 * name + 0.4 * near + 0.1 * float(surface is not None and surface == other)
                if score >= floor:
                    out.append((b, l, r, score))
    return out


@pytest.mark.parametrize(("floor", "keep", "walk_rows"), [(0.5, 2, 1_000_000), (0.5, 3, 0), (0.8, 1, 1_000_000)])
def test_lists_that_run_dry_are_refilled(spark, floor, keep, walk_rows):
    rng = random.Random(4)
    left = events(rng, "l", 60, 2) + events(rng, "m", 12, 30, 2)
    right = events(rng, "r", 50, 2) + events(rng, "s", 14, 30, 2)
    sides = matching.Side("id", ["name", "other"]), matching.Side("id", ["name"])
    got = matching.match(
        spark.createDataFrame(left, EVENT), spark.createDataFrame(right, EVENT), *sides,
        block=["b"], floor=floor, keep=keep, walk_rows=walk_rows,
    )
    assert chosen(got) == walk(all_pairs(left, right, floor))


def test_lists_of_a_crowded_day_stay_short(spark, monkeypatch):
    """Also where the events of one day fill several tiles and many scores are equal."""
    monkeypatch.setattr(candidates, "TILE", 32)
    rng = random.Random(9)
    left, right = events(rng, "l", 150, 1), events(rng, "r", 150, 1)
    frames = spark.createDataFrame(left, EVENT), spark.createDataFrame(right, EVENT)
    side, rule = matching.Side("id", ["name"]), candidates.Rule()
    l, r = (candidates.prepared(df, side, ["b"]) for df in frames)
    found = candidates.lists(l, r, ["b"], rule, 4).collect()
    assert len(found) <= 300 * 4 and all(x.in_l or x.in_r for x in found)
    pairs = all_pairs([(*x[:3], x[2], *x[4:]) for x in left], right, 0.5)
    order = lambda p: (-p[3], hashlib.md5(f"{p[1]}|{p[2]}".encode()).hexdigest())
    for place, flag, more in ((1, "in_l", "l_more"), (2, "in_r", "r_more")):
        for event in {p[place] for p in pairs}:
            own = sorted((p for p in pairs if p[place] == event), key=order)
            rows = [x for x in found if (x.l_id, x.r_id)[place - 1] == event]
            listed = {(x.l_id, x.r_id) for x in rows if x[flag]}
            assert listed == {p[1:3] for p in own[:4]}
            assert len(own) <= 4 or any(x[more] for x in rows)
    assert chosen(matching.match(*frames, side, side, block=["b"], keep=4)) == walk(pairs)


def test_no_events_and_events_without_names_or_days(spark):
    """A missing name is an empty one; events without a block are in none."""
    side = matching.Side("id", ["name"])
    none = spark.createDataFrame([], EVENT)
    some = spark.createDataFrame([(1, "a", None, None, None, None), (1, "b", "rome", None, "hard", None), (None, "c", "rome", "", None, None)], EVENT)
    assert matching.match(none, some, side, side, block=["b"]).collect() == []
    assert matching.match(some, none, side, side, block=["b"]).collect() == []
    assert chosen(matching.match(some, some, side, side, block=["b"])) == {(1, "a", "a"), (1, "b", "b")}
