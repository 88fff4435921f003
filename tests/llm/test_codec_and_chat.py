"""BPE against the tokenizer library, chats against a plain formatter."""

import hashlib
import random
import tracemalloc

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from matchwright.llm import bpe, chat, queries
from matchwright.llm.common import read

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path(bpe.MODEL)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_documents_like_the_library(spark, library):
    docs = read(spark, SF, "documents")
    odd = [
        (-1, None),
        (-2, ""),
        (-3, "a" * 50_000),
        (-4, " \n\t  x \n\n y<|endoftext|> z  "),
        (-5, "日本語 ٣٤ 𝐀𝐁 é́ ՘ I'll we've'd"),
        (-5, "twice"),
        (-5, "twice"),
        (None, "no id"),
    ]
    every = docs.select("doc_id", "text").unionByName(spark.createDataFrame(odd, "doc_id bigint, text string"))
    want = []
    for doc_id, text in every.collect():
        ids = library.encode(text or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        want.append((doc_id, len(ids), sha(",".join(map(str, ids))), sha(back)))
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2])
    assert sorted(map(tuple, bpe.digests(every).collect()), key=key) == sorted(want, key=key)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text_like_the_library(text):
    own, library = bpe.codec(PATH), Tokenizer.from_file(PATH) if not hasattr(bpe, "_lib") else bpe._lib
    bpe._lib = library
    ids = own.encode([text])[0]
    assert ids.tolist() == library.encode(text, add_special_tokens=False).ids
    assert own.decode(ids) == text


def test_random_mixtures_and_a_full_table(library, monkeypatch):
    own = bpe.Codec(PATH)
    monkeypatch.setattr(bpe, "MAX_KNOWN", 50)
    rng = random.Random(3)
    bits = ["a", "b", "e", "the", "ing", " ", "  ", "\n", "\r\n", "'s", "é", "日", "<|endoftext|>", "1", "!", "\xa0", "\x1c", "​"]
    texts = ["".join(rng.choices(bits, k=rng.randint(0, 40))) for _ in range(800)]
    for start in range(0, 800, 40):
        part = texts[start : start + 40]
        got = own.encode(part)
        assert [x.tolist() for x in got] == [e.ids for e in library.encode_batch(part, add_special_tokens=False)]
        assert [own.decode(x) for x in got] == [
            library.decode(e.ids, skip_special_tokens=False) for e in library.encode_batch(part, add_special_tokens=False)
        ]


@pytest.mark.parametrize("kind", ["same letter", "letters", "signs"])
def test_very_long_words_take_little_memory(kind, library):
    rng = random.Random(8)
    n = 400_000
    word = {"same letter": "a" * n, "letters": "".join(rng.choices("abcdeinorst\u00e9\u65e5", k=n)), "signs": "-=" * (n // 2)}[kind]
    own = bpe.codec(PATH)
    own.encode(["warm up"])
    tracemalloc.start()
    got = own.encode([word])[0]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got.tolist() == library.encode(word, add_special_tokens=False).ids
    assert peak < 150 * len(word.encode())


def test_ids_of_any_kind_decode(spark):
    rows = [([50256, 220, 99999, -4],), (None,), ([],), ([162],)]
    got = bpe.decode(spark.createDataFrame(rows, "ids array<int>")).collect()
    assert [r.decoded for r in got] == ["<|endoftext|> ", "", "", "�"]
    empty = spark.createDataFrame([], "doc_id bigint, text string, ids string, extra int")
    assert bpe.encode(empty).columns == ["doc_id", "text", "extra", "ids"]


def plain(turns):
    """What op6 has to return, without formatting anything."""
    learnt = "".join(t for r, t in turns if r == "assistant")
    return (len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(learnt), sha(learnt))


def test_chats_against_plain(spark):
    own = queries.op6_chat_format(spark, SF)
    source = queries.with_probe(read(spark, SF, "conversations")).collect()
    chats = {}
    for r in sorted(source, key=lambda r: (r.conv_id, r.turn)):
        chats.setdefault(r.conv_id, []).append((r.role or "", r.text or ""))
    got = {r[0]: tuple(r)[1:5] for r in own.collect()}
    assert got == {k: plain(v) for k, v in chats.items()}


def test_odd_chats(spark):
    rows = [
        (1, 0, "assistant", "\n\n starts with breaks"),
        (1, 1, "assistant", "<<||im_end||>> <| <|| <|im_sep|>é日"),
        (1, 2, "assistant", ""),
        (1, 2, "assistant", None),
        (2, None, None, None),
        (None, 1, "user", "nobody's"),
        (3, 0, "<|im_end|>", "x<"),
        (4, 0, "user", "first"),
        (4, 0, "user", "first"),
        (5, 0, "assistant", "<|endoftext|>" + "long " * 40_000),
    ]
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    got = {r.conv_id: r for r in chat.digests(chat.format_chats(frame)).collect()}
    chats = {}
    for r in rows:
        chats.setdefault(r[0], []).append((r[2] or "", r[3] or ""))
    assert {k: tuple(r)[1:5] for k, r in got.items()} == {k: plain(v) for k, v in chats.items()}
    extra = frame.limit(0).selectExpr("*", "'x' as formatted", "1 as ids")
    assert chat.digests(chat.format_chats(extra)).collect() == []


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "<|x|>"]), st.text("<|>im_sepndtar é\n", max_size=30)), max_size=5))
def test_render_is_reversible(turns):
    formatted, spans = chat.render(turns)
    assert chat.parse(formatted) == turns
    assert [chat.unescape(formatted[a:b]) for a, b in spans] == [t for _, t in turns]


def test_mask_holds_only_assistant_tokens(spark):
    turns = [("user", "hello there"), ("assistant", " \n\nfine"), ("user", "ok")]
    formatted, spans = chat.render(turns)
    encoded = chat.tokenizer(PATH).encode(formatted, add_special_tokens=False)
    starts, ends = (list(x) for x in zip(*encoded.offsets, strict=True))
    import numpy as np

    mask = chat.token_mask(np.array(starts), np.array(ends), spans[1:2])
    covered = {i for a, b, m in zip(starts, ends, mask, strict=True) if m for i in range(a, b)}
    assert covered == set(range(*spans[1]))
