"""Gestalt ratios of many pairs of texts at once, equal to those of ``difflib``.

The longest common block of every pair is found on padded arrays of characters: one pass over the
left texts keeps, for all pairs and all places in the right texts, how long the run of equal
characters that ends there is. What stands left and right of a block are new pairs, so the recursion
becomes a work list that shrinks with every round.
"""

from __future__ import annotations

from difflib import SequenceMatcher

import numpy as np

CELLS = 1 << 16
# Pairs that are matched at once.
AT_ONCE = 1 << 15
# Run lengths and places share 16 bits; and from this length of the right text on, difflib leaves
# out frequent characters. Longer texts are given to difflib itself.
PLAIN_LENGTH = 200
# Bits of a number, one for each character of the shorter text; classes that characters fall in.
SHORT, CLASSES = 64, 128


def _characters(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All code points in one array, and the length of each text."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.int32), lengths


def _padded(codes: np.ndarray, low: np.ndarray, high: np.ndarray, fill: int) -> np.ndarray:
    """One column per text, filled up below."""
    at = np.arange(int((high - low).max()))[:, None] + low
    inside = at < high
    return np.where(inside, codes[np.where(inside, at, 0)], codes.dtype.type(fill))


def _longest(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start in both texts and length of the longest common block of each column.

    Of equally long blocks it is the first of the left text, and of these the first of the right:
    length, place in the left and place in the right are packed into one number, the places
    counted down, so that the largest number is the block wanted.
    """
    width, pairs = right.shape
    runs = np.zeros((width + 1, pairs), dtype=np.uint16)
    best, grown = np.zeros((width, pairs), np.uint16), np.empty((width, pairs), np.uint16)
    for i, char in enumerate(left):
        np.add(runs[:-1], 256, out=grown)
        np.multiply(grown, right == char, out=grown)
        runs[1:] = grown
        grown += np.uint16(255 - i)
        np.maximum(best, grown, out=best)
    down = (255 - np.arange(width, dtype=np.uint32))[:, None]
    packed = ((best.astype(np.uint32) << 8) | down).max(axis=0).astype(np.int64)
    size = packed >> 16
    return 256 - (packed >> 8 & 255) - size, 256 - (packed & 255) - size, size


def _matched(left: list[str], right: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Characters in common blocks and characters in all, for every pair."""
    (codes_l, size_l), (codes_r, size_r) = _characters(left), _characters(right)
    known, codes = np.unique(np.concatenate([codes_l, codes_r]), return_inverse=True)
    codes = (codes + 2).astype(np.uint8 if len(known) < 254 else np.int32)
    ends = np.cumsum(np.concatenate([size_l, size_r]))
    start_l, start_r = ends[: len(left)] - size_l, ends[len(left) :] - size_r
    total = np.zeros(len(left), np.int64)
    work = np.stack([np.arange(len(left)), start_l, start_l + size_l, start_r, start_r + size_r])
    while True:
        work = work[:, (work[2] > work[1]) & (work[4] > work[3])]
        if not work.shape[1]:
            return total, size_l + size_r
        # Texts of like size together, so that little is padding.
        work = work[:, np.lexsort((work[4] - work[3], work[2] - work[1]))]
        widths = work[4] - work[3]
        found, at = [], 0
        while at < work.shape[1]:
            step = max(64, CELLS // int(widths[at : at + 4096].max()))
            part = work[:, at : at + step]
            found.append(_longest(_padded(codes, part[1], part[2], 0), _padded(codes, part[3], part[4], 1)))
            at += step
        first_l, first_r, size = (np.concatenate(x) for x in zip(*found, strict=True))
        hit = size > 0
        work, first_l, first_r, size = work[:, hit], first_l[hit], first_r[hit], size[hit]
        np.add.at(total, work[0], size)
        cut_l, cut_r = work[1] + first_l, work[3] + first_r
        before = np.stack([work[0], work[1], cut_l, work[3], cut_r])
        after = np.stack([work[0], cut_l + size, work[2], cut_r + size, work[4]])
        work = np.concatenate([before, after], axis=1)


def ratios(left: list[str], right: list[str]) -> np.ndarray:
    """Twice the matched characters by all characters; 1 for two empty texts. The order matters.

    Pairs are matched in parts, so memory does not grow with their number but by the result.
    """
    out = np.ones(len(left))
    open_, long = [], []
    for i, (a, b) in enumerate(zip(left, right, strict=True)):
        if a != b:
            (long if max(len(a), len(b)) >= PLAIN_LENGTH else open_).append(i)
    for i in long:
        out[i] = SequenceMatcher(None, left[i], right[i]).ratio()
    for start in range(0, len(open_), AT_ONCE):
        part = open_[start : start + AT_ONCE]
        matched, total = _matched([left[i] for i in part], [right[i] for i in part])
        out[part] = 2.0 * matched / total
    return out


def _classes(texts: list[str]) -> np.ndarray:
    """One row per text with the class of each character, filled up with a class of its own."""
    codes, lengths = _characters(texts)
    out = np.full((len(texts), max(1, int(lengths.max(initial=0)))), CLASSES, np.uint8)
    at = np.arange(len(codes)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[np.repeat(np.arange(len(texts)), lengths), at] = codes % CLASSES
    return out


def subsequence_bounds(texts: list[str], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """No more characters of the texts numbered ``a`` and ``b`` can be matched.

    Matched blocks are a common subsequence. The longest one of all pairs is found by bit vectors, one
    step per character of the longer text (Hyyro 2004). Characters of one class count as equal, so it
    may come out longer, never shorter; of pairs with longer texts the bound is the shorter length.
    """
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    turned = lengths[a] < lengths[b]
    a, b = np.where(turned, b, a), np.where(turned, a, b)
    out = lengths[b]
    fit = np.flatnonzero((lengths[b] <= SHORT) & (lengths[a] < PLAIN_LENGTH))
    for start in range(0, len(fit), AT_ONCE):
        part = fit[start : start + AT_ONCE]
        (longer, own), (shorter, other) = (np.unique(x[part], return_inverse=True) for x in (a, b))
        places = _classes([texts[i] for i in shorter])
        masks = np.zeros((len(shorter), CLASSES + 1), np.uint64)
        for i in range(places.shape[1]):
            masks[np.arange(len(shorter)), places[:, i]] |= np.uint64(1 << i)
        masks[:, CLASSES] = 0
        flat, base = masks.ravel(), other * (CLASSES + 1)
        left = np.full(len(part), ~np.uint64(0))
        for chars in np.ascontiguousarray(_classes([texts[i] for i in longer]).T):
            met = left & flat[base + chars[own]]
            left = (left + met) | (left - met)
        out[part] = np.bitwise_count(~left)
    return out
