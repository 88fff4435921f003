"""Bounds on the matched characters of names: never too low, and close enough to spare exact ratios."""

import hashlib
import random
from difflib import SequenceMatcher

import numpy as np
import pyarrow as pa

from matchwright.functions import gestalt
from matchwright.operators.candidates import Rule, _Events, _Tile, _upper


def longest(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def test_bounds_are_longest_common_subsequences():
    draw = random.Random(3)
    texts = ["", "a", "a" * 64, "b" * 65, "x" * 250] + [
        "".join(draw.choice("abcd ") for _ in range(draw.randrange(0, 90))) for _ in range(60)
    ]
    texts += ["".join(chr(draw.choice((97, 225, 353, 0x1F3BE))) for _ in range(20)) for _ in range(10)]
    a, b = (x.ravel() for x in np.meshgrid(np.arange(len(texts)), np.arange(len(texts))))
    bounds = gestalt.subsequence_bounds(texts, a, b)
    for i, j, bound in zip(a, b, bounds, strict=True):
        x, y = texts[i], texts[j]
        blocks = SequenceMatcher(None, x, y).get_matching_blocks()
        assert bound >= sum(block.size for block in blocks)
        if (x + y).isascii() and min(len(x), len(y)) <= 64 and max(len(x), len(y)) < 200:
            assert bound == longest(x, y)


def side(names, days):
    kind = pa.list_(pa.struct([("id", pa.int64()), ("text", pa.string()), ("day", pa.int64()), ("surface", pa.string()), ("names", pa.list_(pa.string()))]))
    events = [{"id": i, "text": str(i), "day": d, "surface": "hard", "names": [n]} for i, (n, d) in enumerate(zip(names, days, strict=True))]
    return pa.array([events], kind)


def test_unlike_names_of_a_crowded_day_are_not_rated():
    """Random names share characters enough for the floor, but not in the same order."""
    names = [hashlib.md5(str(i).encode()).hexdigest() for i in range(60)]
    codes, surfaces = {}, {}
    left, right = (_Events(side(names, days), codes, surfaces) for days in ([9] * 60, [9] * 55 + [12] * 5))
    li, ri = (x.ravel() for x in np.meshgrid(np.arange(60), np.arange(60)))
    pairs = _Tile(left, right, li, ri, np.ones(3600, bool), Rule(0.8), list(codes))
    lengths, counts = _upper(list(codes))
    upper = pairs.bounds(lengths, counts)
    assert (upper >= 0.8).sum() > 2000
    assert sorted(pairs.li[pairs.closer(upper, lengths) >= 0.8 - 1e-9].tolist()) == list(range(60))
