"""Language identification by error-correcting output codes.

Every language has a codeword; one binary n-gram classifier per bit tells the languages with a 1
from those with a 0. A text is given the language whose codeword has the least loss, each bit
weighted by how well its classifier did on that language, and is marked ambiguous where a second
codeword is about as near or the read bits lie beyond what the code can correct.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructType

from .common import CHUNK, column, fold, slices, texts

UNKNOWN = "und"
BITS = 15
WIDTH = 2 << BITS


@dataclass(frozen=True)
class Model:
    """``weights`` (n-gram bucket x bit), ``codes`` and ``trust`` (language x bit)."""

    languages: tuple[str, ...]
    codes: np.ndarray
    weights: np.ndarray
    centre: np.ndarray
    scale: np.ndarray
    trust: np.ndarray

    @cached_property
    def corrects(self) -> int:
        """Wrong bits that the code can correct: less than half the least distance of two codewords."""
        apart = [(a != b).sum() for a, b in combinations(self.codes, 2)]
        return (int(min(apart)) - 1) // 2 if apart else 0


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)


def ngrams(text: str) -> Iterator[np.ndarray]:
    """Buckets of the letter pairs and triples of a whole text, piece by piece.

    Case is folded and every run of other characters counts as one space.
    """
    letters = _letters()
    for start in range(0, max(len(text), 1), CHUNK):
        piece = " " + text[max(0, start - 2) : start + CHUNK].lower() + " "
        codes = np.frombuffer(piece.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        letter = letters[codes]
        kept = letter.copy()
        kept[0] = True
        kept[1:] |= letter[:-1]
        line = np.where(letter, codes, np.uint32(0))[kept]
        two = line[:-1] * np.uint32(0x9E3779B1) + line[1:] * np.uint32(0x85EBCA77)
        three = (two[:-1] ^ (two[:-1] >> np.uint32(15))) * np.uint32(0xC2B2AE3D) + line[2:]
        for order, h in enumerate((two, three)):
            h = (h ^ (h >> np.uint32(16))) * np.uint32(0x27D4EB2F)
            yield (h >> np.uint32(32 - BITS)).astype(np.int64) + (order << BITS)


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def codewords(n: int, seed: int = 7) -> np.ndarray:
    """One row of 0/1 per language; no two columns alike, none constant.

    Up to seven languages get every split there is (2**(n-1) - 1 columns). Beyond that the best of
    a fixed number of random codes of 8 log2(n) columns, by the least distance of two rows.
    """
    if n < 2:
        return np.ones((n, 1), dtype=np.int8)
    if n <= 7:
        columns = np.arange(1, 1 << (n - 1))
        return np.vstack([np.ones((1, len(columns))), (columns[None, :] >> np.arange(n - 1)[:, None]) & 1 ^ 1]).astype(
            np.int8
        )
    rng = np.random.default_rng(seed)
    width = int(np.ceil(8 * np.log2(n)))
    best, apart = None, -1
    for _ in range(200):
        code = rng.integers(0, 2, (n, width), dtype=np.int8)
        code[0, code.all(0)] = 0
        code[0, ~code.any(0)] = 1
        signs = code.astype(np.int32) * 2 - 1
        agree = signs @ signs.T - 2 * width * np.eye(n, dtype=np.int32)
        least = (width - int(agree.max())) // 2
        if least > apart:
            best, apart = code, least
    return best


def _labelled(docs: DataFrame, rows_per_language: int, text: str, lang: str, doc_id: str, train) -> DataFrame:
    """About ``rows_per_language`` labelled rows of each language, chosen by a hash of the id."""
    usable = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).where(train)
    sizes = {r[0]: r[1] for r in usable.groupBy(lang).count().collect()}
    part = F.lit(0.0)
    if sizes:
        shares = F.create_map(*[F.lit(x) for k, n in sorted(sizes.items()) for x in (k, rows_per_language / n)])
        part = shares[F.col(lang)]
    draw = F.pmod(F.xxhash64(F.col(doc_id), F.lit("language")), F.lit(1 << 30)) / float(1 << 30)
    return usable.where(draw < part).select(F.col(lang).alias("lang"), F.col(text).alias("text"))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """N-gram counts of each language in one partition."""
    counts: dict[str, np.ndarray] = {}
    for batch in slices(batches):
        for lang, text in zip(column(batch, "lang").to_pylist(), texts(batch), strict=True):
            own = counts.setdefault(lang, np.zeros(WIDTH, dtype=np.int64))
            for buckets in ngrams(text):
                own += np.bincount(buckets, minlength=WIDTH)
    for lang, own in counts.items():
        at = np.flatnonzero(own)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(at), pa.string()), pa.array(at), pa.array(own[at])], names=["lang", "bucket", "n"]
        )


def _reading(text: str, weights: np.ndarray) -> np.ndarray:
    """Mean log odds of every bit over the n-grams of a text."""
    total, n = np.zeros(weights.shape[1]), 0
    for buckets in ngrams(text):
        total += weights[buckets].sum(axis=0, dtype=np.float64)
        n += len(buckets)
    return total / max(n, 1)


def train(
    docs: DataFrame,
    rows_per_language: int = 3000,
    text: str = "text",
    lang: str = "lang",
    doc_id: str = "doc_id",
    use=None,
) -> Model:
    """Fit the classifiers on about ``rows_per_language`` labelled rows of each language.

    ``use`` is a condition on the rows that may be learnt from. Counting runs on the executors;
    the driver gets counts per language and bucket (at most WIDTH rows a language) and one reading
    per sampled row. Without labelled rows the model has no language and every text is ``und``.
    """
    sample = _labelled(docs, rows_per_language, text, lang, doc_id, F.lit(True) if use is None else use)
    counted = (
        sample.mapInArrow(_count, "lang string, bucket bigint, n bigint").groupBy("lang", "bucket").agg(F.sum("n"))
    )
    table = counted.toArrow()
    names = table.column(0).to_pylist()
    languages = tuple(sorted(set(names)))
    codes = codewords(len(languages))
    if not languages:
        empty = np.zeros((0, 1))
        return Model((), empty, np.zeros((WIDTH, 1), np.float32), np.zeros(1), np.ones(1), empty)
    place = {x: i for i, x in enumerate(languages)}
    counts = np.zeros((len(languages), WIDTH))
    counts[[place[x] for x in names], table.column(1).to_numpy()] = table.column(2).to_numpy()
    share = counts + 0.5
    for order in range(2):
        part = slice(order << BITS, (order + 1) << BITS)
        share[:, part] /= share[:, part].sum(axis=1, keepdims=True)
    weights = np.zeros((WIDTH, codes.shape[1]), dtype=np.float32)
    for bit in range(codes.shape[1]):
        on = codes[:, bit] == 1
        one = share[on].mean(axis=0)
        none = share[~on].mean(axis=0) if (~on).any() else one
        weights[:, bit] = np.log(one / none)

    def read_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            readings = [_reading(x, weights).tolist() for x in texts(batch)]
            yield pa.RecordBatch.from_arrays(
                [column(batch, "lang"), pa.array(readings, pa.list_(pa.float64()))], names=["lang", "bits"]
            )

    got = sample.mapInArrow(read_bits, "lang string, bits array<double>").toArrow()
    own = np.array([place[x] for x in got.column(0).to_pylist()])
    bits = np.array(got.column(1).to_pylist())
    means = np.vstack([bits[own == i].mean(axis=0) for i in range(len(languages))])
    on = codes == 1
    high = (means * on).sum(0) / np.maximum(on.sum(0), 1)
    low = (means * ~on).sum(0) / np.maximum((~on).sum(0), 1)
    centre = np.where(on.all(0), 0.0, (high + low) / 2)
    scale = np.maximum(np.abs(high - low) / 2, 1e-6)
    right = ((bits > centre) == on[own]).astype(float)
    trust = np.vstack([right[own == i].mean(axis=0) for i in range(len(languages))]) + 1e-6
    return Model(languages, codes, weights, centre, scale, trust / trust.sum(axis=1, keepdims=True))


def decode(model: Model, reading: np.ndarray) -> tuple[int, float, bool]:
    """Language, score and ambiguity of one text's mean log odds.

    The loss of a bit is exp(-agreement); the score is the share of the best codeword in
    exp(-4 * loss). Ambiguous: score below one half, or more bits wrong than the code corrects.
    """
    signs = model.codes * 2.0 - 1.0
    bits = np.clip((reading - model.centre) / model.scale, -4, 4)
    loss = (model.trust * np.exp(-signs * bits)).sum(axis=1)
    odds = np.exp(-4 * (loss - loss.min()))
    best = int(loss.argmin())
    score = float(odds[best] / odds.sum())
    if len(model.languages) < 2:
        return best, score, False
    wrong = int((signs[best] * bits < 0).sum())
    return best, score, score < 0.5 or wrong > model.corrects


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with lang_pred string, score double and ambiguous boolean.

    Reads whole texts. Null texts, empty texts and texts without a letter: ``und``, score 0, not
    ambiguous. Columns of ``docs`` with these names are replaced; all others, and repeated rows,
    stay as they are.
    """
    own = ["lang_pred", "score", "ambiguous"]
    kept = docs.drop(*own)
    schema = StructType(list(kept.schema.fields)).add("lang_pred", StringType()).add("score", DoubleType()).add("ambiguous", BooleanType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out: list[tuple[str, float, bool]] = []
            for value in texts(batch, text):
                if not model.languages or not has_letter(value):
                    out.append((UNKNOWN, 0.0, False))
                    continue
                best, score, ambiguous = decode(model, _reading(value, model.weights))
                out.append((model.languages[best], score, ambiguous))
            columns = list(zip(*out, strict=True)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array(columns[0], pa.string()),
                    pa.array(columns[1], pa.float64()),
                    pa.array(columns[2], pa.bool_()),
                ],
                names=[*batch.schema.names, *own],
            )

    return kept.mapInArrow(run, schema)


def language_of(docs: DataFrame, held_out: int = 2, folds: int = 4, **options) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, ambiguous), learnt from the rows outside the fold."""
    outside = fold(F.col("doc_id"), folds) != held_out
    model = train(docs, use=outside, **options)
    return identify(
        docs.select("doc_id", (~outside).alias("held_out"), "text"), model
    ).drop("text")


def keep_identified(docs: DataFrame, **options) -> DataFrame:
    """Rows whose language was recognised: neither ``und`` nor ambiguous; columns unchanged.

    The model is learnt from the labelled rows of ``docs`` itself.
    """
    model = train(docs, **options)
    found = identify(docs, model)
    names = [x for x in docs.columns if x not in ("lang_pred", "score", "ambiguous")]
    if len(names) != len(docs.columns):
        clash = {x: f"{x} of the input" for x in docs.columns if x not in names}
        found = identify(docs.withColumnsRenamed(clash), model)
        kept = found.where("lang_pred <> 'und' and not ambiguous")
        return kept.select(*[F.col(f"`{clash[x]}`").alias(x) if x in clash else F.col(x) for x in docs.columns])
    return found.where("lang_pred <> 'und' and not ambiguous").select(*docs.columns)
