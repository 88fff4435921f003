"""Near-duplicates, line dedup and packing against brute force, and odd input."""

import random
import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from matchwright.llm import components, line_dedup, packing, simhash_dedup
from matchwright.llm.common import read

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def groups_of(nodes, links):
    """Least node reached, by union-find."""
    parent = {x: x for x in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return {x: find(x) for x in nodes}


def plain_print(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_groups(rows):
    prints = [(i, plain_print(t)) for i, t in rows]
    links = [
        (a, b)
        for k, (a, x) in enumerate(prints)
        for b, y in prints[:k]
        if a is not None and b is not None and (x ^ y).bit_count() <= 2
    ]
    return groups_of({i for i, _ in prints if i is not None}, links), prints


def test_simhash_against_all_pairs(spark):
    docs = [(r.doc_id, r.text) for r in read(spark, SF, "documents").select("doc_id", "text").collect()]
    base = docs[3][1] * 3
    docs += [(-5, None), (-6, ""), (-7, " \t\n"), (-8, "One two"), (-9, "one TWO"), (9000, base), (9001, base + " end")]
    docs += [(9100 + i, base.replace(" ", "  ", 1) + f" tail{i % 7}") for i in range(60)]
    docs += [(9200, "ÄÖ É"), (9201, "äö é"), (9300, "x " * 200_000)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    want, prints = near_groups(docs)
    got = simhash_dedup.near_duplicate_rows(frame).collect()
    assert sorted((r.doc_id, r.fingerprint, r.component_id) for r in got) == sorted(
        (i, f"{p:016x}", want[i]) for i, p in prints
    )


def test_simhash_repeats_and_nulls(spark):
    rows = [(1, "a b c d"), (1, "a b c d"), (1, "other words are here"), (None, "a b c d"), (None, None), (7, "a b c d")]
    frame = spark.createDataFrame([(*r, "x", "y", 1) for r in rows], SCHEMA)
    got = sorted(simhash_dedup.near_duplicates(frame).collect(), key=str)
    assert len(got) == 6
    kept = simhash_dedup.keep_representatives(frame)
    assert kept.columns == frame.columns
    assert sorted((r.doc_id, r.text) for r in kept.where("doc_id is not null").collect()) == [
        (1, "a b c d"),
        (1, "other words are here"),
    ]
    assert kept.where("doc_id is null").count() == 2
    assert simhash_dedup.near_duplicates(frame.where("false")).collect() == []


@pytest.mark.parametrize("distance", [0, 1, 2, 3, 4])
def test_ball_links_every_distance(spark, distance):
    rng = random.Random(distance)
    seeds = [rng.getrandbits(64) for _ in range(6)]
    prints = set()
    for s in seeds:
        for _ in range(12):
            prints.add(s ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5))))
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    if distance > 2:
        signed = signed[:24]
    frame = spark.createDataFrame([(x,) for x in signed], "fp bigint")
    links = [(r.a, r.b) for r in simhash_dedup.links(frame, distance).collect()]
    bits = lambda a, b: ((a ^ b) & ((1 << 64) - 1)).bit_count()
    every = [(a, b) for i, a in enumerate(signed) for b in signed[:i] if bits(a, b) <= distance]
    assert groups_of(signed, links) == groups_of(signed, every)


def test_components_of_chains_hubs_and_loops(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(5, x) for x in range(1000, 1300)] + [(7, 7), (None, 3), (9, 8), (8, 9)]
    frame = spark.createDataFrame(links, "x bigint, y bigint")
    got = {r.node: r.root for r in components.connected_components(frame).collect()}
    clean = [(a, b) for a, b in links if a is not None and a != b]
    assert got == groups_of({x for p in clean for x in p}, clean)
    assert components.connected_components(frame.where("false")).collect() == []


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def plain_lines(docs):
    """Groups of comparable lines by comparing all pairs of normalised lines."""
    where = defaultdict(list)
    prints = {}
    for doc_id, text in docs:
        for n, line in enumerate((text or "").split("\n")):
            words = line_dedup.normal_line(line)
            if len(words.split()) >= line_dedup.MIN_WORDS:
                where[words].append((doc_id, n))
                prints[words] = int(line_dedup.line_prints(line)[2][0])
    lines = sorted(where)
    links = []
    for i, a in enumerate(lines):
        for b in lines[:i]:
            apart = ((prints[a] ^ prints[b]) & ((1 << 64) - 1)).bit_count()
            longest = max(len(a), len(b))
            if apart <= line_dedup.DISTANCE and 1 - edit_distance(a, b) / longest >= line_dedup.SIMILARITY - 1e-9:
                links.append((a, b))
    group = groups_of(lines, links)
    first = {}
    for words, places in where.items():
        first[group[words]] = min(first.get(group[words], (1 << 60, 0)), min(places))
    return {(*p, *first[group[w]]) for w, places in where.items() for p in places}, len(links)


def variants(rng, line, n):
    words = line.split()
    for _ in range(n):
        own = list(words)
        for _ in range(rng.randint(1, 2)):
            at = rng.randrange(len(own))
            own[at] = rng.choice([own[at] + "x", "new", own[at].upper(), own[at] + ","])
        yield " ".join(own)


def test_lines_against_all_pairs(spark):
    rng = random.Random(5)
    docs = [(r.doc_id, r.text) for r in read(spark, SF, "documents").select("doc_id", "text").limit(40).collect()]
    long = " ".join(rng.choice(["alpha", "beta", "gamma", "delta"]) + str(i) for i in range(60))
    docs += [(1000 + i, f"{v}\nOwn line number {i} of this text") for i, v in enumerate(variants(rng, long, 60))]
    docs += [(2000, "b a c"), (2001, "a b c"), (2002, "c b a c"), (2003, "Of.\nOf."), (2004, None), (2005, "")]
    frame = spark.createDataFrame([(i, t, "x", "y", len(t or "")) for i, t in docs], SCHEMA)
    want, n_links = plain_lines(docs)
    assert n_links > 20
    got = line_dedup.line_groups(frame).collect()
    assert {(r.doc_id, r.line, r.first_doc, r.first_line) for r in got} == want
    assert all(r.kept == ((r.doc_id, r.line) == (r.first_doc, r.first_line)) for r in got)


def test_lines_taken_out(spark):
    rows = [
        (1, "Shared first line of text\nMine alone is this", "x", "s", 44),
        (2, "shared FIRST line, of text!\nOf.\nAnother own line here", "x", "s", 53),
        (3, "Shared first line of text", "x", "s", 25),
        (4, "Of.\nOf.", "x", "s", 7),
        (5, None, "x", "s", None),
        (6, "", "x", "s", 0),
        (7, "Same row twice in here\nsame row twice in here", "x", "s", 45),
        (7, "Same row twice in here\nsame row twice in here", "x", "s", 45),
        (None, "Shared first line of text", "x", "s", 25),
    ]
    frame = spark.createDataFrame(rows, SCHEMA)
    got = line_dedup.without_repeats(frame)
    assert got.columns == frame.columns and got.schema["n_chars"].dataType == frame.schema["n_chars"].dataType
    assert sorted(((r.doc_id, r.text, r.n_chars) for r in got.collect()), key=str) == sorted(
        [
            (1, rows[0][1], 44),
            (2, "Of.\nAnother own line here", 25),
            (4, "Of.\nOf.", 7),
            (5, None, None),
            (6, "", 0),
            (7, "Same row twice in here", 22),
            (None, rows[-1][1], 25),
        ],
        key=str,
    )
    assert line_dedup.without_repeats(frame.where("false")).collect() == []
    clash = frame.withColumnRenamed("source", "line").withColumnRenamed("lang", "kept")
    assert line_dedup.without_repeats(clash).columns == clash.columns


def test_long_texts_have_the_prints_of_their_lines():
    rng = np.random.default_rng(2)
    words = [f"w{i}" for i in rng.integers(0, 500, 400_000)]
    text = "\n".join(" ".join(words[i : i + 1000]) for i in range(0, len(words), 1000)) + "\n" + " ".join(words)
    line, keys, prints = line_dedup.line_prints(text)
    assert line.tolist() == list(range(401))
    for i in (0, 7, 250, 400):
        own = line_dedup.line_prints(text.split("\n")[i])
        assert own[1].tolist() == keys[i : i + 1].tolist() and own[2][0] == prints[i]


def test_pigeonhole_masks_cover_every_difference():
    masks = line_dedup.block_masks(3, 5)
    rng = random.Random(1)
    for _ in range(500):
        flips = sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3)))
        assert any(not m & flips for m in masks)


def plain_best_fit(lengths, capacities, cost):
    """The cheapest of the packings by what is still to come and by one opening size each."""

    def cheapest(bins):
        return [(min((c for c in capacities if c >= sum(b)), key=lambda c: (cost(c), c)), b) for _, b in bins]

    def by_filling(i, size):
        room = size - lengths[i]
        for n in lengths[i + 1 :]:
            room -= n if n <= room else 0
        return min(cost(c) for c in capacities if c >= size - room) / (size - room), -size

    found = []
    for opening in (None, *capacities):
        bins = []
        for i, n in enumerate(lengths):
            fits = [b for b in bins if b[0] - sum(b[1]) >= n]
            if fits:
                best = min(fits, key=lambda b: b[0] - sum(b[1]))
            else:
                able = [c for c in capacities if c >= n]
                if opening is None:
                    size = min(able, key=lambda c: by_filling(i, c))
                else:
                    size = opening if opening >= n else able[0]
                best = [size, []]
                bins.append(best)
            best[1].append(n)
        found.append(cheapest(bins))
    return min(found, key=lambda x: sum(cost(c) for c, _ in x))


def test_sizes_are_opened_by_what_is_to_come():
    cost = packing.sequence_cost
    lengths = np.array([500, 500, 500, 12, 12, 12], dtype=np.int64)
    bins, _, final = packing.best_fit(lengths)
    assert sum(map(cost, final)) <= min(sum(map(cost, packing.place(lengths, packing.CAPACITIES, cost, c)[2])) for c in packing.CAPACITIES)
    rng = np.random.default_rng(3)
    lengths = np.sort(rng.integers(1, 4097, 3000))[::-1].copy()
    opened = packing.place(lengths, packing.CAPACITIES, cost)
    totals = [sum(map(cost, packing.place(lengths, packing.CAPACITIES, cost, c)[2])) for c in packing.CAPACITIES]
    assert len(set(opened[2])) > 1
    assert sum(map(cost, packing.best_fit(lengths)[2])) <= min(totals)


def test_bins_stay_when_partitions_change(spark):
    docs = read(spark, SF, "documents").select("doc_id", "text")
    docs = docs.unionByName(docs.where("doc_id % 3 = 0")).unionByName(docs.selectExpr("cast(null as bigint)", "text").toDF("doc_id", "text"))
    one, other = (
        sorted(tuple(r) for r in packing.pack(docs.repartition(n), shard_rows=100).na.fill(-1).collect()) for n in (2, 5)
    )
    assert one == other and len(one) >= docs.count() - 10


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=80))
def test_best_fit_like_a_plain_one(lengths):
    lengths = sorted(lengths, reverse=True)
    sizes = (16, 32, 64)
    bins, offsets, final = packing.best_fit(np.array(lengths, dtype=np.int64), sizes)
    own = [(int(c), [n for n, b in zip(lengths, bins, strict=True) if b == i]) for i, c in enumerate(final)]
    assert own == plain_best_fit(lengths, sizes, packing.sequence_cost)
    for i in range(len(final)):
        at = 0
        for n, b, o in zip(lengths, bins, offsets, strict=True):
            if b == i:
                assert o == at
                at += n


def test_packing_holds_every_word_once(spark):
    docs = read(spark, "/root/testdata/sf0.01", "documents")
    odd = [(-1, None), (-2, " "), (-3, "w " * 10_001), (-4, "same"), (-4, "same"), (None, "no id at all")]
    frame = docs.select("doc_id", "text").unionByName(spark.createDataFrame(odd, "doc_id bigint, text string"))
    rows = packing.pack(frame, shard_rows=300).collect()
    bins, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        bins[r.bin_id].append(r)
        pieces[r.doc_id].append((r.start, r.length))
    for own in bins.values():
        own.sort(key=lambda r: r.offset)
        assert [r.offset for r in own] == [sum(x.length for x in own[:i]) for i in range(len(own))]
        used = sum(r.length for r in own)
        assert {r.used for r in own} == {used}
        assert {r.capacity for r in own} == {min(c for c in packing.CAPACITIES if c >= used)}
    total = defaultdict(int)
    for doc_id, text in frame.collect():
        total[doc_id] += len((text or "").split())
    assert {k: sum(n for _, n in v) for k, v in pieces.items()} == {k: n for k, n in total.items() if n}
    assert sorted(pieces[-3]) == [(0, 4096), (4096, 4096), (8192, 1809)]
    assert sorted(pieces[-4]) == [(0, 1), (0, 1)]
    held = sum(total.values()) / sum(own[0].capacity for own in bins.values())
    assert held > 0.9
    assert packing.pack(frame.where("false")).collect() == []
    clash = frame.selectExpr("*", "1 as shard", "2 as piece", "3 as length")
    assert packing.pack(clash).count() == packing.pack(frame).count()
