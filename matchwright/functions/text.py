"""Slugs, accent folding and the two name normalisations."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Letters that Unicode does not decompose, with their usual spelling.
LETTERS_ONE = {"Đ": "D", "đ": "d", "Ł": "L", "ł": "l", "Ø": "O", "ø": "o", "Ð": "D", "ð": "d"}
LETTERS_TWO = {"Þ": "Th", "þ": "th", "ß": "ss", "Æ": "Ae", "æ": "ae", "Œ": "Oe", "œ": "oe"}


@lru_cache(maxsize=1)
def _fold_tables() -> tuple[dict[str, str], dict[str, str]]:
    """ASCII part of every character's compatibility decomposition: one letter, or several."""
    one: dict[str, str] = {}
    many: dict[str, str] = {}
    for point in range(0x80, 0x110000):
        if 0xD800 <= point <= 0xDFFF:
            continue
        char = chr(point)
        plain = "".join(c for c in unicodedata.normalize("NFKD", char) if ord(c) < 128)
        if len(plain) == 1:
            one[char] = plain
        elif plain:
            many[char] = plain
    return one, many


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Name a value inside an expression, so that it is built and computed once."""
    return F.transform(F.array(value), body)[0]


def fold_accents(value: Column, *, spell_letters: bool = False) -> Column:
    """Plain ASCII: decompose, keep the ASCII part, drop the rest.

    ``spell_letters`` also spells out letters such as Đ or ß that have no decomposition.
    Rows that are ASCII already cost one pattern test; the character-wise path is taken only by
    rows with a ligature or another character that folds to several letters.
    """
    one, many = _fold_tables()
    if spell_letters:
        one, many = {**one, **LETTERS_ONE}, {**many, **LETTERS_TWO}
    pairs = "\u0001".join(f"{char}\u0002{plain}" for char, plain in many.items())
    table = F.str_to_map(F.lit(pairs), F.lit("\u0001"), F.lit("\u0002"))
    single = F.translate(value, "".join(one), "".join(one.values()))

    def spelled(text: Column) -> Column:
        # Few different characters are left, so each is replaced once in the whole text.
        met = F.array_distinct(F.regexp_extract_all(text, F.lit(r"([^\x00-\x7f])"), F.lit(1)))
        known = F.filter(met, lambda char: table[char].isNotNull())
        return F.aggregate(known, text, lambda out, char: F.replace(out, char, table[char]))

    ascii_only = F.regexp_replace(let(single, spelled), r"[^\x00-\x7f]", "")
    return F.when(value.rlike(r"[^\x00-\x7f]"), ascii_only).otherwise(value)


def slug(value: Column) -> Column:
    """Lower case, every run of other characters becomes one underscore, none at the ends."""
    joined = F.regexp_replace(F.lower(F.trim(value)), "[^a-z0-9]+", "_")
    return F.regexp_replace(joined, "^_+|_+$", "")


def normalize_title(value: Column) -> Column:
    """Event and place names: folded, lower case, words separated by one blank; null gives ''."""
    words = F.regexp_replace(F.lower(fold_accents(value)), "[^a-z0-9]+", " ")
    return F.coalesce(F.trim(words), F.lit(""))


def normalize_name(value: Column) -> Column:
    """Person names: folded, lower case, blanks and hyphens kept, blanks collapsed."""
    kept = F.regexp_replace(F.lower(fold_accents(value, spell_letters=True)), "[^a-z0-9 -]", " ")
    return F.trim(F.regexp_replace(kept, " +", " "))


def compact(value: Column) -> Column:
    """Without blanks and hyphens."""
    return F.translate(value, " -", "")
