"""The SimHash of the pipeline's near-dedup stage."""

import random

from test_dedup import SCHEMA, groups_of, plain_print

import corpus_pipeline
from matchwright.llm import simhash_dedup


def test_near_dedup_links_by_simhash(spark):
    """Texts two bits apart or less are one group, whatever their Jaccard over five words."""
    rng = random.Random(11)
    texts = []
    while len(texts) < 8:
        base = [f"w{rng.randrange(60)}" for _ in range(9)] * 14
        other = [x if i % 9 or rng.random() < 0.6 else f"v{i}" for i, x in enumerate(base)]
        a, b = " ".join(base), " ".join(other)
        one, two = ({tuple(t.split()[i : i + 5]) for i in range(len(base) - 4)} for t in (a, b))
        if (plain_print(a) ^ plain_print(b)).bit_count() <= 2 and len(one & two) < 0.5 * len(one | two):
            texts += [a, b]
    links = [(i, j) for i in range(8) for j in range(i) if (plain_print(texts[i]) ^ plain_print(texts[j])).bit_count() <= 2]
    frame = spark.createDataFrame([(i, t, "x", "y", len(t)) for i, t in enumerate(texts)], SCHEMA)
    got = {r.doc_id for r in corpus_pipeline.one_of_each(spark, frame, "").collect()}
    assert got == set(groups_of(range(8), links).values()) and len(got) < 8
    assert simhash_dedup.near_copies(frame, 5, 0.8).count() == 8
