"""The pipeline's stages, each on what its predecessor kept, against plain versions."""

from collections import Counter, defaultdict

import pytest
from test_dedup import near_groups, plain_lines

import corpus_pipeline
from matchwright.llm import language_id, packing, quality
from matchwright.llm.common import read

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def kept(spark):
    """What every stage returns, the input first."""
    docs = read(spark, SF, "documents")
    odd = spark.createDataFrame(
        [
            (-1, None, "en", "s", None),
            (-2, "", None, "s", 0),
            (-3, "12 34 !", "en", "s", 7),
            (None, docs.first().text, "en", "s", 1),
        ],
        docs.schema,
    )
    out = [docs.unionByName(odd)]
    for _, stage in corpus_pipeline.STAGES:
        frame = stage(spark, out[-1], SF)
        out.append(spark.createDataFrame(frame.collect(), frame.schema))
    return out


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def test_stages_are_named_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language_id",
        "quality",
        "line_dedup",
        "simhash_dedup",
        "packing",
    ]
    assert corpus_pipeline.ORACLE_SQL is None


def test_all_but_the_last_keep_the_columns(kept):
    assert all(x.columns == kept[0].columns and x.dtypes == kept[0].dtypes for x in kept[:5])


def test_language_stage(kept):
    before, after = rows(kept[0]), rows(kept[1])
    assert after <= before
    gone = [r for r in before - after]
    assert {r[0] for r in gone} >= {-1, -2, -3}
    model = language_id.train(kept[0])
    for r in kept[0].collect():
        if language_id.has_letter(r.text):
            _, _, ambiguous = language_id.decode(model, language_id._reading(r.text, model.weights))
            assert ((tuple(r) in after) is not ambiguous)
    assert len(gone) < 12


def test_quality_stage(spark, kept):
    before, after = rows(kept[1]), rows(kept[2])
    assert after <= before
    machine = quality.train(kept[1], read(spark, SF, "labels"))
    for r in kept[1].collect():
        assert (quality.score_one(machine, r.text, r.n_chars) >= 0.3) == (tuple(r) in after)
    known = {r.doc_id: r.quality for r in read(spark, SF, "labels").collect()}
    good = [r for r in kept[1].collect() if known.get(r.doc_id) == 1]
    assert sum(tuple(r) in after for r in good) / len(good) > 0.97


def test_line_stage(kept):
    docs = [(r.doc_id, r.text) for r in kept[2].collect() if r.doc_id is not None]
    groups, _ = plain_lines(docs)
    cut = defaultdict(set)
    for doc, line, first, first_line in groups:
        if (doc, line) != (first, first_line):
            cut[doc].add(line)
    want = {}
    for doc, text in docs:
        lines = [x for i, x in enumerate(text.split("\n")) if i not in cut[doc]]
        if not cut[doc] or any(x.strip(" ") for x in lines):
            want[doc] = "\n".join(lines)
    got = {r.doc_id: r.text for r in kept[3].collect() if r.doc_id is not None}
    assert got == want
    assert all(r.n_chars == len(r.text) for r in kept[3].collect() if cut.get(r.doc_id))


def test_simhash_stage(kept):
    docs = [(r.doc_id, r.text) for r in kept[3].collect()]
    groups, _ = near_groups(docs)
    assert {r.doc_id for r in kept[4].collect() if r.doc_id is not None} == set(groups.values())


def test_packing_stage(kept):
    words = {r.doc_id: len(r.text.split()) for r in kept[4].collect()}
    held = defaultdict(int)
    for r in kept[5].collect():
        held[r.doc_id] += r.length
        assert r.used <= r.capacity and r.capacity in packing.CAPACITIES
    assert dict(held) == {k: n for k, n in words.items() if n}


def test_run_is_the_stages_one_after_the_other(spark):
    docs = read(spark, SF, "documents")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        docs = spark.createDataFrame(docs.collect(), docs.schema)
    whole = corpus_pipeline.run(spark, SF)
    assert rows(docs.select("doc_id", "piece", "start", "length")) == rows(
        whole.select("doc_id", "piece", "start", "length")
    )
