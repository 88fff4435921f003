"""Quality classifier: a factorisation machine over hashed words, structure and metadata.

score = sigmoid(bias + sum w_i x_i + 1/2 sum_f [(sum v_if x_i)^2 - sum v_if^2 x_i^2]), so that all
pairwise interactions cost time linear in the features that are present.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructType

from .common import chunks, column, fold, slices, span_hashes, texts, word_spans

WORD_BITS = 13
WORDS = 1 << WORD_BITS
STATS = (
    "log_chars",
    "log_words",
    "log_lines",
    "word_length",
    "upper",
    "digits",
    "punctuation",
    "symbols",
    "wide",
    "distinct_words",
    "commonest_word",
    "words_a_line",
    "distinct_lines",
    "capitalised",
    "ends_in_symbol",
    "lone_symbol",
)
WIDTH = WORDS + len(STATS)


def _classes() -> np.ndarray:
    """Row per kind of byte: upper, lower, digit, sentence mark, other symbol, beyond ASCII."""
    kind = np.zeros((6, 256), dtype=bool)
    kind[0, ord("A") : ord("Z") + 1] = True
    kind[1, ord("a") : ord("z") + 1] = True
    kind[2, ord("0") : ord("9") + 1] = True
    kind[3, [ord(x) for x in ".,;:?'\"()-"]] = True
    kind[5, 128:] = True
    kind[4, 33:127] = ~kind[:4, 33:127].any(axis=0)
    return kind


_KINDS = _classes()
_KIND = np.where(_KINDS.any(axis=0), _KINDS.argmax(axis=0), 6)


@dataclass(frozen=True)
class Machine:
    """Weights; ``centre`` and ``spread`` standardise the statistics."""

    bias: float
    linear: np.ndarray
    factors: np.ndarray
    centre: np.ndarray
    spread: np.ndarray


def features(text: str | None, n_chars: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(buckets, values, statistics) of a whole text.

    Words are runs without ASCII white space, hashed in lower case; their counts are damped and
    scaled to length one. ``n_chars`` is the metadata column; null takes the text's own length.
    Null and empty texts have no words and zero statistics but for n_chars.
    """
    data = (text or "").encode("utf-8", "surrogatepass")
    counts = np.zeros(WORDS, dtype=np.int64)
    bytes_of = np.zeros(7, dtype=np.int64)
    words = letters = capitals = tails = lone = 0
    for piece in chunks(data):
        raw = np.frombuffer(piece, dtype=np.uint8)
        if not len(raw):
            continue
        kind = _KIND[raw]
        bytes_of += np.bincount(kind, minlength=7)
        starts, ends = word_spans(raw)
        if not len(starts):
            continue
        lower = np.where(kind == 0, raw + 32, raw).astype(np.uint8)
        h = span_hashes(lower, starts, ends)
        counts += np.bincount((h >> np.uint64(64 - WORD_BITS)).astype(np.int64), minlength=WORDS)
        words += len(starts)
        letters += int((ends - starts).sum())
        capitals += int((kind[starts] == 0).sum())
        tails += int((kind[ends - 1] == 4).sum())
        lone += int(((kind[starts] == 4) & (ends - starts == 1)).sum())
    at = np.flatnonzero(counts)
    values = np.log1p(counts[at])
    norm = np.sqrt((values**2).sum())
    lines = (text or "").split("\n")
    size = max(len(data), 1)
    stats = np.array(
        [
            np.log1p(n_chars if n_chars is not None and n_chars >= 0 else len(text or "")),
            np.log1p(words),
            np.log1p(len(lines)) if data else 0.0,
            letters / max(words, 1),
            bytes_of[0] / size,
            bytes_of[2] / size,
            bytes_of[3] / size,
            bytes_of[4] / size,
            bytes_of[5] / size,
            len(at) / max(words, 1),
            counts.max() / max(words, 1),
            words / len(lines),
            len(set(lines)) / len(lines) if data else 0.0,
            capitals / max(words, 1),
            tails / max(words, 1),
            lone / max(words, 1),
        ]
    )
    return at, values / norm if norm else values, stats


def _row(machine: Machine, text: str | None, n_chars: int | None) -> tuple[np.ndarray, np.ndarray]:
    at, values, stats = features(text, n_chars)
    return _joined(at, values, stats, machine.centre, machine.spread)


def _joined(at, values, stats, centre, spread) -> tuple[np.ndarray, np.ndarray]:
    scaled = np.clip((stats - centre) / spread, -4, 4) / np.sqrt(len(STATS))
    return np.concatenate([at, np.arange(WORDS, WIDTH)]), np.concatenate([values, scaled])


def score_one(machine: Machine, text: str | None, n_chars: int | None = None) -> float:
    at, x = _row(machine, text, n_chars)
    v = machine.factors[at]
    total = x @ v
    pairs = 0.5 * float((total**2).sum() - ((x**2) @ (v**2)).sum())
    z = machine.bias + float(x @ machine.linear[at]) + pairs
    return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def fit(
    rows: list[tuple[np.ndarray, np.ndarray, np.ndarray]],
    labels: np.ndarray,
    rank: int = 6,
    epochs: int = 12,
    rate: float = 0.15,
    decay: float = 1e-5,
    seed: int = 11,
) -> Machine:
    """Adagrad on the logistic loss over mini-batches; the same rows give the same machine."""
    rng = np.random.default_rng(seed)
    stats = np.array([r[2] for r in rows])
    centre, spread = stats.mean(axis=0), np.maximum(stats.std(axis=0), 1e-3)
    joined = [_joined(*r, centre, spread) for r in rows]
    sizes = np.array([len(a) for a, _ in joined])
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    all_at = np.concatenate([a for a, _ in joined])
    all_x = np.concatenate([x for _, x in joined])
    y = labels.astype(float)
    share = np.clip(y.mean(), 0.01, 0.99)
    bias = float(np.log(share / (1 - share)))
    linear, factors = np.zeros(WIDTH), rng.normal(0, 0.02, (WIDTH, rank))
    seen_b, seen_w, seen_v = 1e-2, np.full(WIDTH, 1e-2), np.full((WIDTH, rank), 1e-2)
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for start in range(0, len(order), 64):
            batch = order[start : start + 64]
            n = sizes[batch]
            pick = np.repeat(offsets[batch] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
            at, x = all_at[pick], all_x[pick]
            cut = np.concatenate([[0], np.cumsum(n)[:-1]])
            v = factors[at]
            xv = x[:, None] * v
            total = np.add.reduceat(xv, cut)
            z = bias + np.add.reduceat(x * linear[at], cut)
            z += 0.5 * ((total**2).sum(1) - np.add.reduceat((xv**2).sum(1), cut))
            wrong = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[batch]) / len(batch)
            each = np.repeat(wrong, n)
            slope = each[:, None] * x[:, None] * (np.repeat(total, n, axis=0) - xv)
            keys, back = np.unique(at, return_inverse=True)
            g_w = np.bincount(back, each * x) + decay * linear[keys]
            g_v = np.stack([np.bincount(back, slope[:, f]) for f in range(rank)], axis=1) + decay * factors[keys]
            g_b = wrong.sum()
            seen_b += g_b**2
            seen_w[keys] += g_w**2
            seen_v[keys] += g_v**2
            bias -= rate * g_b / np.sqrt(seen_b)
            linear[keys] -= rate * g_w / np.sqrt(seen_w[keys])
            factors[keys] -= rate * g_v / np.sqrt(seen_v[keys])
    return Machine(bias, linear, factors, centre, spread)


def train(
    docs: DataFrame,
    labels: DataFrame,
    use: Column | None = None,
    rows_per_class: int = 3000,
    label: str = "quality",
) -> Machine:
    """A machine learnt from about ``rows_per_class`` labelled documents of each class.

    ``use`` is a condition on the ids that may be learnt from. Labels other than 0 and 1 and null
    ids don't count; of several labels of one document the least holds. The chosen ids are bounded
    by the parameter, so they are broadcast to the documents; the words of the chosen documents
    are counted on the executors, and the driver fits the sample. Without both classes the machine
    gives every text the share of class 1 (0.5 without labels).
    """
    known = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull())
    if use is not None:
        known = known.where(use)
    known = known.groupBy("doc_id").agg(F.min(label).cast("int").alias("label"))
    sizes = {r[0]: r[1] for r in known.groupBy("label").count().collect()}
    width = np.zeros(len(STATS))
    if len(sizes) < 2:
        share = 0.99 if sizes.get(1) else 0.01 if sizes else 0.5
        return Machine(float(np.log(share / (1 - share))), np.zeros(WIDTH), np.zeros((WIDTH, 1)), width, width + 1)
    draw = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("quality")), F.lit(1 << 30)) / float(1 << 30)
    share = F.when(F.col("label") == 1, rows_per_class / sizes[1]).otherwise(rows_per_class / sizes[0])
    chosen = known.where(draw < share).select("doc_id", "label").toArrow()
    sample = docs.sparkSession.createDataFrame(chosen, "doc_id bigint, label int")
    wanted = docs.select("doc_id", "text", F.col("n_chars").cast("bigint").alias("n_chars"))

    def read_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            got = [
                (doc, y, *(x.tolist() for x in features(text, n)))
                for doc, y, text, n in zip(
                    column(batch, "doc_id").to_pylist(),
                    column(batch, "label").to_pylist(),
                    texts(batch),
                    column(batch, "n_chars").to_pylist(),
                    strict=True,
                )
            ]
            yield pa.RecordBatch.from_pylist(
                [dict(zip(schema.names, r, strict=True)) for r in got], schema=schema
            )

    doubles = pa.list_(pa.float64())
    schema = pa.schema(
        [("doc_id", pa.int64()), ("label", pa.int32()), ("at", pa.list_(pa.int32())), ("x", doubles), ("stats", doubles)]
    )
    read = wanted.join(F.broadcast(sample), "doc_id").select("doc_id", "label", "text", "n_chars")
    rows = read.mapInArrow(
        read_features, "doc_id bigint, label int, at array<int>, x array<double>, stats array<double>"
    ).toArrow()
    if not rows.num_rows:
        return Machine(0.0, np.zeros(WIDTH), np.zeros((WIDTH, 1)), width, width + 1)
    got = [
        (int(d), int(y), np.asarray(a, np.int64), np.asarray(x, float), np.asarray(s, float))
        for d, y, a, x, s in zip(*(rows.column(i).to_pylist() for i in range(5)), strict=True)
    ]
    got.sort(key=lambda r: (r[0], len(r[2]), r[4].tolist()))
    y = np.array([r[1] for r in got])
    machine = fit([r[2:] for r in got], y)
    # The sample holds the classes in other shares than the labels do: shift the bias back.
    true, drawn = sizes[1] / sum(sizes.values()), np.clip(y.mean(), 1e-3, 1 - 1e-3)
    shift = np.log(true / (1 - true)) - np.log(drawn / (1 - drawn))
    return Machine(machine.bias + float(shift), machine.linear, machine.factors, machine.centre, machine.spread)


def score(docs: DataFrame, machine: Machine, threshold: float = 0.3) -> DataFrame:
    """``docs`` with quality_score double and quality_ok int (1 if the score reaches the threshold).

    Reads whole texts; null and empty texts are scored by their statistics and the bias. Columns
    of these two names are replaced, all others and repeated rows stay.
    """
    own = ["quality_score", "quality_ok"]
    kept = docs.drop(*own)
    named = "n_chars" in kept.columns
    schema = StructType(list(kept.schema.fields)).add("quality_score", DoubleType()).add("quality_ok", IntegerType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sizes = column(batch, "n_chars").to_pylist() if named else [None] * batch.num_rows
            scores = [
                score_one(machine, text, None if n is None else int(n))
                for text, n in zip(texts(batch), sizes, strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array(scores, pa.float64()),
                    pa.array([int(x >= threshold) for x in scores], pa.int32()),
                ],
                names=[*batch.schema.names, *own],
            )

    return kept.mapInArrow(run, schema)


def quality_of(docs: DataFrame, labels: DataFrame, held_out: int = 0, folds: int = 5, **options) -> DataFrame:
    """(doc_id, held_out, score, predicted), learnt from the labels outside the fold."""
    outside = fold(F.col("doc_id"), folds) != held_out
    machine = train(docs, labels, outside, **options)
    scored = score(docs.select("doc_id", (~outside).alias("held_out"), "text", "n_chars"), machine)
    return scored.select(
        "doc_id", "held_out", F.col("quality_score").alias("score"), F.col("quality_ok").alias("predicted")
    )


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, **options) -> DataFrame:
    """Rows whose score reaches the threshold; columns unchanged."""
    machine = train(docs, labels, **options)
    clash = {x: f"{x} of the input" for x in ("quality_score", "quality_ok") if x in docs.columns}
    kept = score(docs.withColumnsRenamed(clash), machine, threshold).where("quality_ok = 1")
    return kept.select(*[F.col(f"`{clash[x]}`").alias(x) if x in clash else F.col(f"`{x}`") for x in docs.columns])
