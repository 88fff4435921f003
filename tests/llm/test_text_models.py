"""Language identification and quality: accuracy on held-out rows, and odd input."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from matchwright.llm import language_id, quality
from matchwright.llm.common import read

SF = "/root/testdata/sf0.01"
ODD = "doc_id bigint, text string, lang string, source string, n_chars bigint, score string, ambiguous string"


@pytest.fixture(scope="module")
def docs(spark):
    return read(spark, SF, "documents")


def odd_rows(spark, docs):
    long = "the of and to in that " * 300_000
    rows = [
        (None, None, None, None, None, "x", "y"),
        (-1, "", "en", "s", 0, "x", "y"),
        (-2, "123 !? 456", "en", "s", 10, "x", "y"),
        (-3, long, "en", "s", len(long), "x", "y"),
        (-3, long, "en", "s", len(long), "x", "y"),
        (-4, None, "fr", "s", -5, "x", "y"),
    ]
    return spark.createDataFrame(rows, ODD)


def test_language_held_out(spark, docs):
    got = language_id.language_of(docs).join(docs.select("doc_id", "lang", "text"), "doc_id").collect()
    assert len(got) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    held = [r for r in got if r.held_out and r.lang and r.text]
    assert sum(r.lang_pred == r.lang for r in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in got)
    clear = [r for r in held if len(r.text) > 200]
    assert sum(r.ambiguous for r in clear) / len(clear) < 0.03


def test_language_odd_rows(spark, docs):
    model = language_id.train(docs, rows_per_language=50)
    odd = odd_rows(spark, docs)
    got = language_id.identify(odd, model).collect()
    assert [r.lang_pred for r in got] == ["und", "und", "und", "en", "en", "und"]
    assert got[0].score == 0 and not got[0].ambiguous
    kept = language_id.keep_identified(docs.limit(300).unionByName(odd.select(docs.columns)))
    assert kept.columns == docs.columns and kept.where("doc_id < 0").count() == 2
    clash = language_id.keep_identified(odd)
    assert clash.columns == odd.columns
    none = language_id.identify(odd, language_id.train(odd.where("false")))
    assert {r.lang_pred for r in none.collect()} == {"und"}
    assert language_id.keep_identified(odd.where("false")).collect() == []


def test_codewords_are_apart():
    for n in (2, 3, 4, 5, 7, 12, 40):
        code = language_id.codewords(n)
        assert len({tuple(r) for r in code}) == n
        assert not code.all(axis=0).any() and code.any(axis=0).all()
    assert (language_id.codewords(4)[0] != language_id.codewords(4)[1]).sum() == 4


def test_decoding_corrects_a_wrong_bit():
    code = language_id.codewords(4)
    model = language_id.Model(
        ("a", "b", "c", "d"), code, None, np.zeros(7), np.ones(7), np.full((4, 7), 1 / 7)
    )
    for i in range(4):
        for wrong in range(7):
            bits = code[i] * 2.0 - 1
            bits[wrong] = -bits[wrong]
            best, _, _ = language_id.decode(model, bits)
            assert best == i
    assert language_id.decode(model, np.zeros(7))[2]


def test_quality_held_out(spark, docs):
    labels = read(spark, SF, "labels")
    got = quality.quality_of(docs, labels)
    rows = got.join(labels.select("doc_id", "quality"), "doc_id").collect()
    assert got.count() == docs.count()
    held = [r for r in rows if r.held_out]
    good = np.array([r.score for r in held if r.quality == 1])
    bad = np.array([r.score for r in held if r.quality == 0])
    assert (good[:, None] > bad[None, :]).mean() > 0.95
    assert np.mean([r.predicted == r.quality for r in held]) > 0.93
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)


def test_quality_odd_rows(spark, docs):
    labels = read(spark, SF, "labels")
    machine = quality.train(docs, labels, rows_per_class=60)
    odd = odd_rows(spark, docs)
    got = quality.score(odd, machine).collect()
    assert len(got) == 6 and all(0 <= r.quality_score <= 1 for r in got)
    assert got[3].quality_score == got[4].quality_score
    kept = quality.keep_good(docs.unionByName(odd.select(docs.columns)), labels, rows_per_class=60)
    assert kept.columns == docs.columns
    assert quality.train(docs, labels.where("false")).bias == 0
    assert quality.train(docs.where("false"), labels).bias == 0
    assert quality.quality_of(docs.where("false"), labels).collect() == []


def test_pair_terms_by_the_sum_of_squares():
    rng = np.random.default_rng(0)
    machine = quality.Machine(
        0.3,
        rng.normal(size=quality.WIDTH),
        rng.normal(size=(quality.WIDTH, 4)) * 0.1,
        np.zeros(len(quality.STATS)),
        np.ones(len(quality.STATS)),
    )
    text = "One two two three, four! FIVE"
    at, x = quality._row(machine, text, None)
    pairs = sum(
        float(machine.factors[at[i]] @ machine.factors[at[j]]) * x[i] * x[j] for i in range(len(at)) for j in range(i)
    )
    z = machine.bias + sum(machine.linear[a] * v for a, v in zip(at, x, strict=True)) + pairs
    assert quality.score_one(machine, text) == pytest.approx(1 / (1 + np.exp(-z)))
    swapped = text.replace("two two", "two  two")
    assert quality.features(text)[0].tolist() == quality.features(swapped)[0].tolist()


def test_sample_is_bounded(spark, docs):
    sample = language_id._labelled(docs, 20, "text", "lang", "doc_id", F.lit(True))
    counts = {r[0]: r[1] for r in sample.groupBy("lang").count().collect()}
    assert all(n < 60 for n in counts.values())
