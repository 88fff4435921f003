"""Top-k search, vector dedup and licence scans against brute force, and odd input."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from matchwright.llm import licenses, topk_search, vector_dedup
from matchwright.llm.common import read

SF = "/root/testdata/sf0.001"
VECTORS = "vec_id bigint, embedding array<float>, label int"


def is_usable(v):
    return v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v)


def odd_vectors(extra=()):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=6).tolist(), 0) for i in range(0, 260)]
    rows += [(300 + i, rows[0][1], 1) for i in range(90)]
    rows += [
        (600 + i, (np.array(rows[1][1]) + rng.normal(size=6) * 0.1).tolist(), 1) for i in range(90)
    ]
    rows += [
        (700, None, 0),
        (800, [], 0),
        (900, [0.0] * 6, 0),
        (901, [-0.0] * 6, 0),
        (1000, [1.0, None, 0.0, 0.0, 0.0, 0.0], 0),
        (1100, [math.nan] + [0.0] * 5, 0),
        (1200, [math.inf] + [0.0] * 5, 0),
        (1300, [1.0, 2.0], 0),
        (1301, [2.0, 4.0], 0),
        (1400, [3e5, -2e5, 1e5, 0.0, 1.0, 2.0], 0),
        (None, rows[2][1], 0),
    ]
    return rows + list(extra)


def plain_top(rows, k):
    v = [(i, [math.floor(1024 * float(np.float32(x))) for x in e]) for i, e, _ in rows if i is not None and is_usable(e)]
    out = []
    for n, (q, own) in enumerate(v):
        if q % 100 == 0:
            scored = [
                (-sum(a * b for a, b in zip(own, other, strict=True)), i)
                for m, (i, other) in enumerate(v)
                if m != n and len(other) == len(own)
            ]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(sorted(scored)[:k])]
    return sorted(out)


@pytest.mark.parametrize("k,block", [(1, 2048), (10, 64), (500, 2048)])
def test_top_k_against_brute_force(spark, k, block):
    rows = odd_vectors()
    rows += [(100, rows[7][1], 2), (100, rows[100][1], 2), (3, rows[3][1], 2), (300, rows[5][1], 2)]
    frame = spark.createDataFrame(rows, VECTORS).selectExpr("*", "1 as id", "'x' as score", "'y' as name")
    got = topk_search.top_k(frame, F.col("vec_id") % 100 == 0, k, block_rows=block)
    assert sorted(tuple(r) for r in got.collect()) == plain_top(rows, k)


def test_top_k_small_and_empty(spark):
    frame = spark.createDataFrame([(100, [1.0], 0)], VECTORS)
    assert topk_search.top_k(frame, F.col("vec_id") % 100 == 0).collect() == []
    assert topk_search.top_k(frame.where("false"), F.col("vec_id") % 100 == 0).collect() == []
    two = spark.createDataFrame([(100, [1.0], 0), (3, [2.0], 0), (3, [2.0], 0)], VECTORS)
    assert [tuple(r) for r in topk_search.top_k(two, F.col("vec_id") % 100 == 0).collect()] == [
        (100, 1, 3, 1024 * 2048),
        (100, 2, 3, 1024 * 2048),
    ]


def plain_near(rows, threshold):
    able = [(i, j) for j, (i, e, _) in enumerate(rows) if is_usable(e) and any(e)]
    unit = {}
    for _, j in able:
        e = np.array(rows[j][1], dtype=np.float32).astype(float)
        unit[j] = e / np.sqrt((e * e).sum())
    links = {j: {k for _, k in able if k != j and len(unit[k]) == len(unit[j]) and unit[j] @ unit[k] >= threshold} for _, j in able}
    out = []
    for j, (i, _, _) in enumerate(rows):
        seen, todo = {j}, [j]
        while todo:
            for k in links.get(todo.pop(), ()):
                if k not in seen:
                    seen.add(k)
                    todo.append(k)
        ids = [rows[k][0] for k in seen if rows[k][0] is not None]
        least = min(ids) if ids else None
        out.append((i, len(links.get(j, ())), least, i is not None and i == least))
    return sorted(out, key=str)


@pytest.mark.parametrize("threshold,tile", [(0.9, 2048), (0.9, 40), (0.7, 40), (0.999, 40)])
def test_vectors_against_all_pairs(spark, threshold, tile):
    rows = odd_vectors([(5, [1.0] * 6, 3), (5, [-1.0, 1.0, 1.0, 1.0, 1.0, 1.0], 3)])
    frame = spark.createDataFrame(rows, VECTORS).selectExpr("*", "1 as id", "2 as root", "3 as tile")
    got = vector_dedup.near_vectors(frame, threshold, tile_rows=tile, sample_rows=100)
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain_near(rows, threshold)


def test_no_vectors(spark):
    frame = spark.createDataFrame(odd_vectors(), VECTORS)
    assert vector_dedup.near_vectors(frame.where("false")).collect() == []
    none = vector_dedup.near_vectors(frame.where("vec_id = 700")).collect()
    assert [tuple(r) for r in none] == [(700, 0, 700, True)]


def plain_dice(a, b):
    x, y = (Counter(zip(w, w[1:], strict=False)) for w in (a, b))
    size = sum(x.values()) + sum(y.values())
    return 2 * sum((x & y).values()) / size if size else 0


def plain_scan(text):
    units = {tuple(licenses.normalised(u)) for u in [*(text or "").split("\n"), *__import__("re").split(r"\n[ \t\r]*\n", text or ""), text or ""]}
    hits = []
    for unit in units:
        for i, (name, template) in enumerate(licenses.TEMPLATES):
            dice = plain_dice(list(unit), licenses.normalised(template))
            if dice >= licenses.THRESHOLD:
                hits.append((dice, -i, name, unit))
    if not hits:
        return None, None, 0
    best = max(hits)
    return best[2], best[0], len({h[3] for h in hits})


def test_licences_against_all_templates(spark):
    texts = {r.doc_id: r.text for r in read(spark, SF, "documents").select("doc_id", "text").limit(60).collect()}
    mit = licenses.TEMPLATES[10][1]
    texts |= {
        -1: None,
        -2: "",
        -3: mit,
        -4: "A title\n\n" + mit.replace(". ", ".\n") + "\n\nBody text of the thing.",
        -5: mit.replace("Software", "Program", 2).upper(),
        -6: "released, under the MIT license!\nReleased under the MIT License.",
        -7: "Licensed under the Apache License Version 2.0.\n" + "word " * 50_000,
        -8: mit[: len(mit) // 2],
        -9: "MIT",
        -10: "\n\n\n",
    }
    frame = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").selectExpr("*", "1 as unit", "2 as row")
    got = {r.doc_id: tuple(r)[1:] for r in licenses.scan(frame).collect()}
    want = {k: plain_scan(v) for k, v in texts.items()}
    assert got.keys() == want.keys()
    for k, (name, dice, n) in want.items():
        assert got[k][0] == name and got[k][2] == n and (dice is None or got[k][1] == pytest.approx(dice)), k


def test_licences_of_repeated_and_missing_ids(spark):
    rows = [(1, "Released under the MIT License."), (1, "Released under the MIT License."), (1, "no"), (None, "Licensed under CC BY-NC 4.0.")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: tuple(r)[1:] for r in licenses.scan(frame).collect()}
    assert got == {1: ("MIT", 1.0, 1), None: ("CC-BY-NC-4.0", 1.0, 1)}
    assert licenses.scan(frame.where("false")).collect() == []
    assert licenses.scan(frame, templates=()).collect()[0].license_id is None


def test_size_bounds_lose_nothing():
    for n in (1, 3, 10, 57):
        low, high = licenses.size_bounds(n, 0.8)
        for m in range(1, 200):
            assert (2 * min(m, n) / (m + n) >= 0.8) == (low <= m <= high)


def test_top_k_needs_few_rounds(spark, monkeypatch):
    """The k-th scores of the blocks bound the search, so one histogram is enough."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(1500, 12))
    rows = [(i, v) for i, v in enumerate((x / np.linalg.norm(x, axis=1, keepdims=True)).tolist())]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    states = []

    def counted(df):
        states.append(df)
        return materialize(df)

    materialize = topk_search.materialize
    monkeypatch.setattr(topk_search, "materialize", counted)
    counted_top = topk_search.top_k(frame, F.col("vec_id") % 100 == 0, 10, block_rows=512)
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in counted_top.collect())
    q = np.floor(np.array([v for _, v in rows]) * 1024).astype(np.int64)
    want = []
    for i in range(0, 1500, 100):
        s = q @ q[i]
        order = [j for j in np.lexsort((np.arange(1500), -s)) if j != i][:10]
        want += [(i, n, int(j), int(s[j])) for n, j in enumerate(order, 1)]
    assert got == sorted(want)
    assert len(states) == 2


def test_tiles_are_copied_by_groups(spark, monkeypatch):
    """Where all tiles meet, a tile is shuffled once a group, not once for every other tile."""
    rows = []
    deal = vector_dedup.dealt

    def counted(blocks, size):
        out = deal(blocks, size)
        rows.append((blocks.count(), size, out.count()))
        return out

    monkeypatch.setattr(vector_dedup, "dealt", counted)
    monkeypatch.setattr(vector_dedup, "GROUPS", 5)
    rng = np.random.default_rng(9)
    x = rng.normal(size=(400, 3))
    vectors = [(i, v, 0) for i, v in enumerate(x.tolist())]
    frame = spark.createDataFrame(vectors, VECTORS)
    got = vector_dedup.near_vectors(frame, 0.2, tile_rows=10, sample_rows=100)
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain_near(vectors, 0.2)
    (tiles, size, copies), = rows
    assert tiles >= 40 and size >= 8
    assert copies <= tiles * 7
