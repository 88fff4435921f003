"""The conversation trie against plain dictionaries, also cut into tiny shards and blocks."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from matchwright.llm import conversation_trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def plain(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            digest = hashlib.md5((text or "").encode()).hexdigest()
            own[conv].append(((turn is not None, turn or 0, (role or "").encode(), digest), (role or "", text or "")))
    turns = {c: [t for _, t in sorted(v)] for c, v in own.items()}
    built = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        built[c] = tuple(turns.get(base, [])[:h] + turns[c][h:])
    members = defaultdict(list)
    for c, seq in built.items():
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[x] for x in children[node]) or 1
        bytes_ = len(node[-1][1].encode()) if node else 0
        saved[node] = (len(members[node]) - 1) * bytes_ + sum(saved[x] for x in children[node])
    out = []
    for node, convs in members.items():
        ends = ",".join(str(c) for c in sorted(convs) if len(built[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        sha = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(convs), len(node), parent, len(convs), len(children[node]), leaves[node], saved[node], sha))
    return sorted(out, key=str)


def shown(df):
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert df.columns == columns
    return sorted(map(tuple, df.collect()), key=str)


SMALL = [{}, {"width": 3, "rows": 4, "head": 2}, {"width": 2, "rows": 1, "head": 1}]


@pytest.mark.parametrize("cut", SMALL)
def test_random_conversations(spark, cut):
    pick = random.Random(11)
    rows = []
    for c in pick.sample(range(-40, 200), 90):
        for t in range(pick.choice([1, 2, 3, 5, 9, 12, 20])):
            text = pick.choice(["a", "b", "é", None]) if t > 1 else "hello"
            rows.append((c, pick.choice([t, t, t, None, 3]), pick.choice(["user", "user", None, "assistant"]), text))
    rows += rows[:7] + [(None, 1, "user", "lost"), (7, None, None, None)]
    pick.shuffle(rows)
    frame = spark.createDataFrame([(*r, "x", 5) for r in rows], f"{SCHEMA}, head string, n bigint").repartition(5)
    assert shown(conversation_trie.trie(frame, **cut)) == plain(rows)


@pytest.mark.parametrize("cut", SMALL[:2])
def test_copies_and_one_long_conversation(spark, cut):
    long = [(3, t, "user", f"{t % 7}") for t in range(300)]
    twin = [(8, t, "user", f"{t % 7}") for t in range(299)]
    copies = [(1000 + 5 * i, t, "user", "same") for i in range(120) for t in range(12)]
    single = [(2001 + 5 * i, 0, "user", "one") for i in range(40)]
    rows = long + twin + copies + single
    assert shown(conversation_trie.trie(spark.createDataFrame(rows, SCHEMA), **cut)) == plain(rows)


def test_empty_table_and_turnless_conversations(spark):
    assert shown(conversation_trie.trie(spark.createDataFrame([], SCHEMA))) == []
    rows = [(c, 0, "user", "x" * 100_000) for c in (1, 2, 3, 4, 6, 7, 8, 9)]
    assert shown(conversation_trie.trie(spark.createDataFrame(rows, SCHEMA))) == plain(rows)
    assert any(r[1] == 0 and r[4] == 0 for r in plain([(1, 0, "user", "x")]))
    one = [(1, 0, "user", "x")]
    assert shown(conversation_trie.trie(spark.createDataFrame(one, SCHEMA))) == plain(one)
