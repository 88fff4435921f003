"""Block-Max MaxScore against plain scoring of every document."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from matchwright.llm import lexical_search as lexical

DOCS, ITEMS = "doc_id bigint, text string", "item_id bigint, text string"


def terms(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(lexical.TERM, text)


def plain(docs, items, k=10):
    bags = [(d, Counter(terms(t))) for d, t in docs]
    full = [b for _, b in bags if b]
    n, total = len(full), sum(b.total() for b in full)
    df = Counter(t for b in full for t in b)
    asked = {}
    for item, text in items:
        asked.setdefault(item, set()).update(terms(text))
    out = []
    for item, own in asked.items():
        scores = []
        for doc, bag in bags:
            if doc is None or not bag:
                continue
            m = 10 + 90 * bag.total() * n // total
            weights = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) for t in own if t in bag}
            score = sum(w * (1_000_000_000 * bag[t] // (1000 * bag[t] + 8 * m)) for t, w in weights.items())
            if score > 0:
                scores.append((-score, doc))
        out += [(item, rank, doc, -s) for rank, (s, doc) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def corpus(seed, n):
    pick = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["É", "日本", "x1"]
    weights = [1 / (i + 1) for i in range(len(words))]
    text = lambda most: " ".join(pick.choices(words, weights, k=pick.randint(0, most))).upper()
    docs = [(i, text(pick.choice([5, 30, 200]))) for i in range(n)]
    docs += [(docs[3][0], docs[3][1]), (n, docs[4][1]), (n + 1, docs[4][1]), (n + 2, None), (n + 3, "--"), (None, "w1 w59")]
    items = [(i, text(12)) for i in range(25)] + [(40, None), (41, ""), (42, "absent words"), (None, "w3 w50"), (2, "w40")]
    return docs, items


@pytest.mark.parametrize("cut", [{}, {"shard_docs": 40, "block": 4}, {"shard_docs": 1, "block": 1}])
def test_equal_to_scoring_everything(spark, cut):
    docs, items = corpus(5, 300 if cut.get("shard_docs") != 1 else 30)
    frame = spark.createDataFrame([(*d, 1, "t") for d in docs], f"{DOCS}, df bigint, term string").repartition(3)
    asked = lexical.item_terms(spark.createDataFrame([(*i, "t") for i in items], f"{ITEMS}, term string"))
    for known in (asked, None):
        own = lexical.index(frame, known, **cut)
        got = lexical.search(own, asked, span=16 if cut else lexical.SPAN, block_items=7)
        assert sorted(map(tuple, got.collect()), key=str) == plain(docs, items)


def test_more_results_than_documents_and_empty_tables(spark):
    docs, items = [(1, "a b"), (2, "a")], [(1, "a b c"), (2, "z")]
    frames = spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)
    none = spark.createDataFrame([], DOCS), spark.createDataFrame([], ITEMS)
    assert sorted(map(tuple, lexical.ranked(*frames).collect()), key=str) == plain(docs, items)
    assert lexical.ranked(none[0], frames[1]).collect() == []
    assert lexical.ranked(frames[0], none[1]).collect() == []


def test_long_texts_are_read_whole():
    word = "é" * 700_000
    found = lexical.counts(f"a {word} " + "b c " * 600_000 + "END")
    assert found == {b"a": 1, word.encode(): 1, b"b": 600_000, b"c": 600_000, b"end": 1}


def test_blocks_are_exact():
    pick = np.random.default_rng(1)
    for top in (2, 300, 70_000, 2**31):
        docs = np.cumsum(pick.integers(1, min(top, 4000), 128))
        tfs = pick.integers(1, top, 128)
        back = lexical.unpack(lexical.pack(docs, tfs))
        assert back[0].tolist() == docs.tolist() and back[1].tolist() == tfs.tolist()
    assert [x.tolist() for x in lexical.unpack(lexical.pack(np.array([7]), np.array([3])))] == [[7], [3]]


def shard(pick, n, shares, block):
    """Lists over n documents of ascending length, a term in a share of them."""
    total = lexical.Corpus(n, 50 * n)
    lengths = np.sort(pick.integers(5, 100, n))
    norms, out = total.norms(lengths), []
    for share in shares:
        docs = np.flatnonzero(pick.random(n) < share)
        tfs = pick.integers(1, 4, len(docs))
        cuts = [(a, min(a + block, len(docs))) for a in range(0, len(docs), block)]
        out.append(
            lexical.List(
                np.array([docs[b - 1] for _, b in cuts], np.int64),
                np.array([tfs[a:b].max() for a, b in cuts], np.int64),
                np.array([lengths[docs[a]] for a, _ in cuts], np.int64),
                [lexical.pack(docs[a:b], tfs[a:b]) for a, b in cuts],
                norms,
                total,
            )
        )
    return out


@pytest.mark.parametrize("seed", range(8))
def test_blocks_of_common_terms_stay_packed(seed):
    pick, n = np.random.default_rng(seed), 20_000
    ids = pick.permutation(n)
    common, rare = shard(pick, n, (0.6, 0.4, 0.003, 0.002), 64)[:2], shard(np.random.default_rng(seed), n, (0.6, 0.4, 0.003, 0.002), 64)[2:]
    lists = [(3, common[0]), (5, common[1]), (900, rare[0]), (1100, rare[1])]
    got = lexical.best(lists, ids, 10, span=1024)
    scores = np.zeros(n, np.int64)
    for weight, own in shard_scores(lists):
        scores[own[0]] += weight * own[1]
    order = np.lexsort((ids, -scores))[:10]
    assert got[0].tolist() == ids[order].tolist() and got[1].tolist() == scores[order].tolist()


def shard_scores(lists):
    return [(w, (np.concatenate(x[0]), np.concatenate(x[1]))) for w, x in ((w, all_of(own)) for w, own in lists)]


def all_of(own):
    parts = [lexical.unpack(b) for b in own.blocks]
    return [d for d, _ in parts], [lexical.impact(t, own.norms[d]) for d, t in parts]


def test_candidates_are_rejected_before_unpacking():
    pick, n = np.random.default_rng(3), 40_000
    lists = shard(pick, n, (0.7, 0.002), 64)
    lexical.best([(2, lists[0]), (1500, lists[1])], np.arange(n), 10, span=1024)
    assert len(lists[0].open) < len(lists[0].blocks) / 4
