"""Ratios of many pairs are computed in parts: equal to difflib, in memory that the parts bound."""

import random
import tracemalloc
from difflib import SequenceMatcher

from matchwright.functions import gestalt


def _pairs(n):
    rng = random.Random(7)
    names = ["".join(rng.choices("abcdef 0123", k=rng.randint(0, 34))) for _ in range(400)]
    return rng.choices(names, k=n), rng.choices(names, k=n)


def test_parts_give_the_ratios_of_difflib(monkeypatch):
    monkeypatch.setattr(gestalt, "AT_ONCE", 7)
    left, right = _pairs(300)
    want = [SequenceMatcher(None, a, b).ratio() for a, b in zip(left, right, strict=True)]
    assert gestalt.ratios(left, right).tolist() == want


def test_memory_is_that_of_a_part():
    left, right = _pairs(200_000)
    tracemalloc.start()
    gestalt.ratios(left, right)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100 << 20
