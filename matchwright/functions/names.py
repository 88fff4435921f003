"""Abbreviated names ("Surname I.") against full names ("Given Surname")."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import compact, let, normalize_name

# The surname is the shortest head after which only dotted words follow; one word always stays.
_ABBREVIATED = r"(?U)^\s*(\S+(?:\s+\S+)*?)((?:\s+\S*\.)*)\s*$"


def surname(value: Column) -> Column:
    return normalize_name(F.regexp_extract(value, _ABBREVIATED, 1))


def initials(value: Column) -> Column:
    dotted = F.regexp_extract(value, _ABBREVIATED, 2)
    return normalize_name(F.regexp_replace(dotted, r"(?U)[\s.]+", ""))


def parse_abbreviated(value: Column) -> Column:
    """``struct(surname, initials)`` of an abbreviated name."""
    return F.struct(surname(value).alias("surname"), initials(value).alias("initials"))


def trailing_runs(full_name: Column) -> Column:
    """Every surname a full name could carry, as ``array<struct<run, given>>``.

    ``run`` is the compact text of the last n words and ``given`` the words before them. Of equal
    texts only the shortest run stays, so a surname meets one entry at most. Exploding this array
    turns the name test into an equality join on ``run``.
    """

    def runs(words: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(1), F.size(words)),
            lambda n: F.struct(
                compact(F.array_join(F.slice(words, F.size(words) - n + 1, n), "")).alias("run"),
                F.slice(words, F.lit(1), F.size(words) - n).alias("given"),
            ),
        )

    def shortest(found: Column) -> Column:
        texts = F.transform(found, lambda r: r["run"])
        return F.filter(found, lambda r, i: F.array_position(texts, r["run"]) == i + 1)

    return let(F.split(normalize_name(full_name), " "), lambda words: let(runs(words), shortest))


def initials_fit(letters: Column, given: Column) -> Column:
    """No initials fit anything; otherwise a prefix of the first given name or a letter each."""
    length = F.length(letters)
    first_fits = F.try_element_at(given, F.lit(1)).startswith(letters)
    each_fits = (F.size(given) >= length) & F.forall(
        F.sequence(F.lit(1), length),
        lambda i: F.substring(F.try_element_at(given, i), 1, 1) == F.substr(letters, i, F.lit(1)),
    )
    return (length == 0) | ((F.size(given) > 0) & (first_fits | each_fits))


def names_compatible(abbreviated: Column, full_name: Column) -> Column:
    """True where the abbreviated name can stand for the full one; a missing name never can."""

    def fits(short: Column) -> Column:
        hit = F.filter(trailing_runs(full_name), lambda r: r["run"] == compact(short["surname"]))
        return let(
            hit,
            lambda h: (F.size(h) > 0)
            & initials_fit(short["initials"], F.try_element_at(h, F.lit(1))["given"]),
        ) & (short["surname"] != "")

    return F.coalesce(let(parse_abbreviated(abbreviated), fits), F.lit(False))


def names_conflict(abbreviated: Column, full_name: Column) -> Column:
    """True where both names are there and cannot be the same person."""
    present = (
        abbreviated.isNotNull()
        & full_name.isNotNull()
        & (F.trim(abbreviated) != "")
        & (F.trim(full_name) != "")
    )
    return F.coalesce(present, F.lit(False)) & ~names_compatible(abbreviated, full_name)
