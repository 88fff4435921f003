"""Chat formatting with loss masks aligned by character offsets.

A conversation is rendered as a whole and encoded once. The spans of the turns' texts and of the
tokens are both sorted, so binary search finds the tokens of every assistant text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import AddedToken, Tokenizer, pre_tokenizers, processors

from .common import column, slices

MODEL = "byte_bpe_50k.json"
OPEN, MIDDLE, CLOSE = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
LEARNT = "assistant"
TURN = regex.compile(r"<\|im_start\|>(.*?)<\|im_sep\|>(.*?)<\|im_end\|>", regex.DOTALL)


def escape(text: str) -> str:
    """One more bar in every run of bars after a <, so that no control string is left."""
    return regex.sub(r"<(\|+)", r"<\1|", text)


def unescape(text: str) -> str:
    return regex.sub(r"<\|(\|+)", r"<\1", text)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted conversation and the span of every turn's escaped text."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{OPEN}{escape(role)}{MIDDLE}", escape(text)
        spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, CLOSE]
        at += len(head) + len(body) + len(CLOSE)
    return "".join(parts), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts read back from a formatted conversation."""
    return [(unescape(role), unescape(text)) for role, text in TURN.findall(formatted)]


@lru_cache(maxsize=2)
def tokenizer(path: str) -> Tokenizer:
    """The vocabulary with the control strings as added tokens, offsets untrimmed."""
    own = Tokenizer.from_file(path)
    own.encode_special_tokens = False
    own.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, trim_offsets=False)
    own.post_processor = processors.ByteLevel(trim_offsets=False)
    own.add_special_tokens([AddedToken(x, normalized=False) for x in (OPEN, MIDDLE, CLOSE)])
    return own


def token_mask(starts: np.ndarray, ends: np.ndarray, spans: list[tuple[int, int]]) -> np.ndarray:
    """Tokens that overlap one of the sorted spans.

    Starts and ends of tokens ascend, so the tokens of a span are one run: from the first that
    ends after the span begins to the last that begins before it ends.
    """
    mask = np.zeros(len(starts), dtype=bool)
    for begin, end in spans:
        if end > begin:
            mask[np.searchsorted(ends, begin, "right") : np.searchsorted(starts, end, "left")] = True
    return mask


def under_mask(
    formatted: str, starts: np.ndarray, ends: np.ndarray, mask: np.ndarray, spans: list[tuple[int, int]]
) -> list[str]:
    """Text under the mask, one unescaped string per span that it touches."""
    out = []
    for begin, end in spans:
        own = slice(np.searchsorted(ends, begin, "right"), np.searchsorted(starts, end, "left"))
        held = mask[own]
        a, b = np.maximum(starts[own][held], begin), np.minimum(ends[own][held], end)
        # Runs of tokens that touch or share a character are one piece of text.
        reach = np.maximum.accumulate(b)
        new = np.flatnonzero(np.r_[True, a[1:] > reach[:-1]]) if len(a) else np.zeros(0, np.int64)
        last = np.r_[new[1:], len(a)] - 1 if len(a) else new
        out.append(unescape("".join(formatted[x:y] for x, y in zip(a[new], reach[last], strict=True))))
    return out


def format_chats(conversations: DataFrame, path: str | None = None) -> DataFrame:
    """(conv_id, formatted, ids, starts, ends, loss): one row per conversation.

    ``starts`` and ``ends`` are the tokens' character offsets in ``formatted``; ``loss`` marks the
    tokens of assistant texts. Turns are ordered by turn, role and text, nulls first; null roles
    and texts are empty; rows that repeat are turns of their own. Rows with a null conv_id form one
    conversation. Other columns are ignored.

    A conversation is the unit that is encoded, so one task holds one conversation at a time, as
    the sorted rows of a shuffle by conv_id.
    """
    place = path or public_tokenizers.path(MODEL)

    def run(turns: pd.DataFrame) -> pd.DataFrame:
        rows = [(r or "", t or "") for r, t in zip(turns["role"], turns["text"], strict=True)]
        formatted, spans = render(rows)
        encoded = tokenizer(place).encode(formatted, add_special_tokens=False)
        offsets = np.array(encoded.offsets, dtype=np.int64).reshape(-1, 2)
        learnt = [span for span, (role, _) in zip(spans, rows, strict=True) if role == LEARNT]
        mask = token_mask(offsets[:, 0], offsets[:, 1], learnt)
        return pd.DataFrame(
            {
                "conv_id": turns["conv_id"].iloc[:1].astype("Int64"),
                "formatted": [formatted],
                "ids": [encoded.ids],
                "starts": [offsets[:, 0]],
                "ends": [offsets[:, 1]],
                "loss": [mask],
            }
        )

    def ordered(turns: pd.DataFrame) -> pd.DataFrame:
        filled = turns.assign(role_key=turns["role"].fillna(""), text_key=turns["text"].fillna(""))
        return run(filled.sort_values(["turn", "role_key", "text_key"], na_position="first", kind="stable"))

    source = conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), "turn", F.col("role"), F.col("text")
    )
    return source.groupBy("conv_id").applyInPandas(
        ordered,
        "conv_id bigint, formatted string, ids array<int>, starts array<bigint>, ends array<bigint>, loss array<boolean>",
    )


def digests(chats: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars), read back from ``format_chats``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = []
            for i in range(batch.num_rows):
                formatted = column(batch, "formatted")[i].as_py()
                starts, ends, loss = (
                    column(batch, x)[i].values.to_numpy(zero_copy_only=False) for x in ("starts", "ends", "loss")
                )
                spans = [m.span(2) for m in TURN.finditer(formatted) if unescape(m[1]) == LEARNT]
                turns = parse(formatted)
                learnt = "".join(under_mask(formatted, starts, ends, loss, spans))
                rows.append(
                    {
                        "conv_id": column(batch, "conv_id")[i].as_py(),
                        "n_turns": len(turns),
                        "turns_sha256": hashlib.sha256(
                            "".join(f"{role}\n{text}\n" for role, text in turns).encode()
                        ).hexdigest(),
                        "loss_chars": len(learnt),
                        "loss_sha256": hashlib.sha256(learnt.encode()).hexdigest(),
                        "formatted_chars": len(formatted),
                    }
                )
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    schema = pa.schema(
        [
            ("conv_id", pa.int64()),
            ("n_turns", pa.int64()),
            ("turns_sha256", pa.string()),
            ("loss_chars", pa.int64()),
            ("loss_sha256", pa.string()),
            ("formatted_chars", pa.int64()),
        ]
    )
    return chats.mapInArrow(
        run,
        "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint",
    )
