"""Byte-level BPE by a trie of distinct words.

BPE gives every prefix of a word exactly one last token, and the encoding of the prefix is that
token after the encoding of what stands before it. A trie node therefore needs one state, its last
token, found from the states of its ancestors; prefixes that words share are encoded once.
"""

from __future__ import annotations

import json
import unicodedata
from array import array
from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructType
from tokenizers import Tokenizer

from .common import column, slices

MODEL = "byte_bpe_50k.json"
MAX_KNOWN = 600_000
MAX_FITS = 500_000
NEVER = 1 << 60

# The word pattern and the byte letters of byte-level BPE: fixed values of the format.
WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
DOUBLE_SPACE = [" " + x for x in map(chr, range(0x3001)) if x.isspace()]
PLAIN_BYTES = [*range(33, 127), *range(161, 173), *range(174, 256)]


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the vocabulary file."""
    rest = [b for b in range(256) if b not in set(PLAIN_BYTES)]
    return {chr(b): b for b in PLAIN_BYTES} | {chr(256 + i): b for i, b in enumerate(rest)}


@lru_cache(maxsize=1)
def _unassigned() -> np.ndarray:
    """Code points on whose class Unicode versions may differ."""
    return np.fromiter((unicodedata.category(chr(i)) == "Cn" for i in range(0x110000)), bool, 0x110000)


def _doubtful(text: str) -> bool:
    if text.isascii() or max(text) < "\u0378":
        return False
    return bool(_unassigned()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)].any())


def shared(a: bytes, b: bytes) -> int:
    """Length of the prefix that two words share."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    return next(i for i in range(n) if a[i] != b[i])


class Endings:
    """Which tokens end at a place, longest first, for places read byte by byte.

    A state is the longest beginning of a token that ends at the place (Aho and Corasick, CACM
    1975); ``longest`` has the longest token that ends in a state, ``shorter`` the next one.
    """

    def __init__(self, tokens: dict[bytes, int]) -> None:
        self.next: dict[int, int] = {}
        self.fall, self.longest, depth = [0], [-1], [0]
        self.shorter: dict[int, int] = {}
        for token, i in tokens.items():
            state = 0
            for byte in token:
                below = self.next.get(state << 8 | byte)
                if below is None:
                    below = self.next[state << 8 | byte] = len(self.fall)
                    self.fall.append(0)
                    self.longest.append(-1)
                    depth.append(depth[state] + 1)
                state = below
            self.longest[state] = i
        for key, state in sorted(self.next.items(), key=lambda x: depth[x[1]]):
            above, byte = key >> 8, key & 255
            if above:
                self.fall[state] = self.walk(self.fall[above], byte)
            other = self.longest[self.fall[state]]
            if self.longest[state] < 0:
                self.longest[state] = other
            else:
                self.shorter[self.longest[state]] = other
        self.met: dict[int, int] = {}

    def walk(self, state: int, byte: int) -> int:
        """The state after one more byte."""
        while True:
            found = self.next.get(state << 8 | byte)
            if found is not None:
                return found
            if not state:
                return 0
            state = self.fall[state]

    def step(self, state: int, byte: int) -> int:
        """As ``walk``, remembered in ``met``."""
        if len(self.met) > MAX_FITS:
            self.met.clear()
        found = self.met[state << 8 | byte] = self.walk(state, byte)
        return found


class Codec:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, letters = spec["model"], byte_letters()
        pre = spec["pre_tokenizer"] or {}
        if model["type"] != "BPE" or pre.get("type") != "ByteLevel" or spec["normalizer"] or pre.get("add_prefix_space"):
            raise ValueError("a byte-level BPE file without normaliser and prefix space is needed")
        if model["dropout"] or model["ignore_merges"] or model["continuing_subword_prefix"] or model["end_of_word_suffix"]:
            raise ValueError("plain merges are needed")
        self.library = Tokenizer.from_file(path)
        self.bytes_of = {i: bytes(letters[x] for x in token) for token, i in model["vocab"].items()}
        self.id_of = {b: i for i, b in self.bytes_of.items()}
        if any(bytes([b]) not in self.id_of for b in range(256)):
            raise ValueError("a token for every byte is needed")
        by_name = model["vocab"]
        pairs = [x if isinstance(x, list) else x.split(" ") for x in model["merges"]]
        self.pairs = [(by_name[left], by_name[right], by_name[left + right]) for left, right in pairs]
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        if any(x["lstrip"] or x["rstrip"] or x["single_word"] or x["normalized"] for x in spec["added_tokens"]):
            raise ValueError("plain added tokens are needed")
        names = sorted(self.special, key=len, reverse=True)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None
        self.bytes_of |= {i: x.encode() for x, i in self.special.items()}
        self.fits: dict[int, bool] = {}
        size = max(self.bytes_of) + 1
        self.token_size = np.array([len(self.bytes_of.get(i, b"")) for i in range(size)], np.int64)
        self.token_start = np.cumsum(self.token_size) - self.token_size
        self.token_bytes = np.frombuffer(b"".join(self.bytes_of.get(i, b"") for i in range(size)), np.uint8)
        self.forget()

    @cached_property
    def merges(self) -> dict[int, tuple[int, int]]:
        """Rank and result of every merge, by both tokens; of a pair that is listed twice the first counts."""
        return {a << 32 | b: (rank, c) for rank, (a, b, c) in reversed(list(enumerate(self.pairs)))}

    @cached_property
    def made(self) -> dict[int, tuple[int, int, int]]:
        """Last merge (left, right, rank) of every token of several bytes that encodes to itself.

        If both parts do and nothing is merged across their border in time, so does the token;
        others are merged byte by byte.
        """
        out: dict[int, tuple[int, int, int]] = {}
        whole = {self.id_of[bytes([b])] for b in range(256)}
        for rank, (a, b, c) in enumerate(self.pairs):
            if c in whole:
                continue
            if a in whole and b in whole and self.fit(a, b, out, c):
                out[c] = a, b, rank
                whole.add(c)
            elif last := self.built(c):
                out[c] = last
                whole.add(c)
        return out

    @cached_property
    def endings(self) -> Endings:
        """The tokens that encode to themselves."""
        return Endings({token: i for token, i in self.id_of.items() if len(token) == 1 or i in self.made})

    def forget(self) -> None:
        """Start the table of known segments anew: entry 0 is the line break."""
        self.known: dict[str, int] = {}
        self.spaced: dict[str, int] = {}
        self.flat = np.zeros(0, np.int32)
        self.size = np.zeros(0, np.int64)
        self.first = np.zeros(0, np.int64)

    def built(self, token: int) -> tuple[int, int, int] | None:
        """Last merge (left, right, rank) of a token's own bytes, None if they encode to something else."""
        parts, last = [self.id_of[bytes([b])] for b in self.bytes_of[token]], None
        while len(parts) > 1:
            pairs = [x << 32 | y for x, y in zip(parts, parts[1:], strict=False)]
            found = [(self.merges[p][0], i) for i, p in enumerate(pairs) if p in self.merges]
            if not found:
                break
            rank, at = min(found)
            last = parts[at], parts[at + 1], rank
            parts[at : at + 2] = [self.merges[pairs[at]][1]]
        return last if parts == [token] else None

    def fit(self, first: int, second: int, made: dict[int, tuple[int, int, int]], allowed: int = -1) -> bool:
        """Whether two tokens may stand side by side: no merge across the border comes in time.

        Along its edges a token was made of ever smaller tokens, each of which lived until the rank
        that took it in; the whole token lives for ever. At equal ranks the leftmost merge goes
        first, so a merge across the border loses against the one that takes in its left token and
        wins against the one that takes in its right. The merge that gives ``allowed`` of both
        whole tokens doesn't count.
        """
        merges = self.merges
        a, until = first, NEVER
        while True:
            b, still = second, NEVER
            while True:
                merge = merges.get(a << 32 | b)
                if merge and merge[0] < until and merge[0] <= still and not (
                    merge[1] == allowed and a == first and b == second
                ):
                    return False
                if b not in made:
                    break
                b, _, still = made[b]
            if a not in made:
                return True
            _, a, until = made[a]

    def encode_trie(self, words: list[bytes]) -> tuple[array, array]:
        """Ids of the sorted words of a trie one after the other, and their number per word.

        The trie is compressed: sorted words are its leaves in order, and what a word shares with
        the one before it is the path down to the node where they part. So an unbranched chain
        costs no nodes, and only the states on the current path are held: ``tokens[d]`` is the last
        token of its prefix of d bytes. The longest token that ends the prefix and may follow the
        last token before it is the right one.
        """
        ends = self.endings
        met, step, longest, shorter = ends.met, ends.step, ends.longest, ends.shorter
        fits, made, size = self.fits, self.made, self.token_size.tolist()
        room = max(map(len, words), default=0) + 1
        tokens, states = array("i", bytes(4 * room)), array("i", bytes(4 * room))
        flat, sizes, before = array("i"), array("q"), b""
        for word in words:
            at = shared(before, word)
            before, state = word, states[at]
            for byte in word[at:]:
                at += 1
                state = states[at] = met.get(state << 8 | byte) or step(state, byte)
                token = longest[state]
                while size[token] < at:
                    pair = tokens[at - size[token]] << 32 | token
                    known = fits.get(pair)
                    if known is None:
                        if len(fits) > MAX_FITS:
                            fits.clear()
                        known = fits[pair] = self.fit(pair >> 32, token, made)
                    if known:
                        break
                    token = shorter[token]
                tokens[at] = token
            ids = []
            while at:
                ids.append(tokens[at])
                at -= size[tokens[at]]
            sizes.append(len(ids))
            flat.extend(reversed(ids))
        return flat, sizes

    def words(self, text: str) -> list[str | int]:
        """Words of a text in order; an added token is its id."""
        parts = self.cut.split(text) if any(x in text for x in self.special) else [text]
        out: list[str | int] = []
        for part in parts:
            if part in self.special:
                out.append(self.special[part])
            elif _doubtful(part):
                out.extend(part[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(part))
            else:
                out.extend(WORD.findall(part))
        return out

    def learn(self, segments: set[str], spaced: set[str]) -> None:
        """Ids of segments not met before; those of ``spaced`` have a space before them.

        Words always begin at a space or a line break before a character that is no white space,
        so the words of such a segment don't depend on its neighbours. The table starts anew when
        it is full, which changes no result.
        """
        fresh = [(self.known, "", [x for x in segments if x not in self.known])]
        fresh.append((self.spaced, " ", [x for x in spaced if x not in self.spaced]))
        n = len(self.size)
        if n and n + sum(len(x) for _, _, x in fresh) > MAX_KNOWN:
            raise KeyError("full")
        # Letters alone are one word, with or without the space before them.
        alone = [(table, space, [x for x in new if x.isalpha()]) for table, space, new in fresh]
        split = [(table, x, self.words(space + x)) for table, space, new in fresh for x in new if not x.isalpha()]
        words = {space + x for _, space, new in alone for x in new}
        words.update(word for _, _, parts in split for word in parts if isinstance(word, str))
        ordered = sorted(words)  # code points are in the order of their bytes
        flat, sizes = self.encode_trie([x.encode("utf-8", "surrogatepass") for x in ordered])
        row = dict(zip(ordered, range(n, n + len(ordered)), strict=True))
        for table, space, new in alone:
            table.update((x, row[space + x]) for x in new)
        first = np.cumsum(sizes, dtype=np.int64) - np.array(sizes, dtype=np.int64)
        for table, segment, parts in split:
            if len(parts) == 1 and isinstance(parts[0], str):
                table[segment] = row[parts[0]]
                continue
            table[segment], before = n + len(sizes), len(flat)
            for word in parts:
                if isinstance(word, str):
                    at = row[word] - n
                    flat.extend(flat[first[at] : first[at] + sizes[at]])
                else:
                    flat.append(word)
            sizes.append(len(flat) - before)
        self.flat = np.concatenate([self.flat, np.asarray(flat, np.int32)])
        self.size = np.concatenate([self.size, np.asarray(sizes, np.int64)])
        self.first = np.cumsum(self.size) - self.size

    def segments(self, text: str) -> list[tuple[str, list[str]]] | list[str]:
        """(first segment, further segments without their space) of every line.

        Texts in which white space follows white space, and texts with added tokens, are given
        word by word.
        """
        lines = [line.split(" ") for line in text.split("\n")]
        odd = (
            any(not x[0] or x[0][0].isspace() for x in lines)
            or any(x in text for x in DOUBLE_SPACE)
            or any(x in text for x in self.special)
        )
        if odd:
            names = {i: x for x, i in self.special.items()}
            return [x if isinstance(x, str) else names[x] for x in self.words(text)]
        return [(parts[0], parts[1:]) for parts in lines]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of every text; the words of all texts together go through the tries once."""
        split = [self.segments(x) for x in texts]
        heads, rest = {"\n"}, set()
        for lines in split:
            for line in lines:
                if isinstance(line, str):
                    heads.add(line)
                else:
                    heads.add(line[0])
                    rest.update(line[1])
        try:
            self.learn(heads, rest)
        except KeyError:
            self.forget()
            self.learn(heads, rest)
        out, line_break = [], self.known["\n"]
        for lines in split:
            own: list[int] = []
            for line in lines:
                if isinstance(line, str):
                    own.append(self.known[line])
                    continue
                if own:
                    own.append(line_break)
                own.append(self.known[line[0]])
                own.extend(map(self.spaced.__getitem__, line[1]))
            at = np.array(own, dtype=np.int64)
            n = self.size[at]
            total = int(n.sum())
            out.append(self.flat[np.repeat(self.first[at] - (np.cumsum(n) - n), n) + np.arange(total)])
        return out

    def decode(self, ids: np.ndarray) -> str:
        """Text of a list of ids; added tokens are their own text, broken bytes the mark U+FFFD.

        Ids that the vocabulary doesn't have are left out.
        """
        ids = ids[(ids >= 0) & (ids < len(self.token_size))].astype(np.int64)
        n = self.token_size[ids]
        pick = np.repeat(self.token_start[ids] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        return self.token_bytes[pick].tobytes().decode("utf-8", "replace")


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """The codec of a file, made once per worker."""
    return Codec(path)


def _groups(values: list[str | None], chars: int = 2_000_000) -> Iterator[list[str]]:
    """Runs of texts of about so many characters together; null is empty."""
    group: list[str] = []
    size = 0
    for value in values:
        group.append(value or "")
        size += len(group[-1])
        if size >= chars:
            yield group
            group, size = [], 0
    if group:
        yield group


def encode(docs: DataFrame, path: str | None = None, text: str = "text") -> DataFrame:
    """``docs`` with ids array<int>: the tokenizer library's encoding of the whole text.

    ``path`` names the vocabulary file, which every executor must have. Null texts are empty, and
    empty texts have no ids. Strings of added tokens become their ids. A column ``ids`` of the
    input is replaced; other columns and repeated rows stay.
    """
    place = path or public_tokenizers.path(MODEL)
    kept = docs.drop("ids")
    schema = StructType(list(kept.schema.fields)).add("ids", ArrayType(IntegerType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(place)
        for batch in slices(batches):
            at = 0
            for group in _groups(column(batch, text).to_pylist()):
                got = own.encode(group)
                ends = np.cumsum([0, *map(len, got)]).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(got).astype(np.int32)))
                part = batch.slice(at, len(group))
                at += len(group)
                yield pa.RecordBatch.from_arrays([*part.columns, ids], names=[*part.schema.names, "ids"])

    return kept.mapInArrow(run, schema)


def decode(tokens: DataFrame, path: str | None = None) -> DataFrame:
    """``tokens`` with decoded string from its column ids; null ids give an empty text."""
    place = path or public_tokenizers.path(MODEL)
    kept = tokens.drop("decoded")
    schema = StructType(list(kept.schema.fields)).add("decoded", StringType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(place)
        for batch in slices(batches, 128):
            lists = (x.values if x.is_valid else pa.array([], pa.int32()) for x in column(batch, "ids"))
            decoded = [own.decode(np.asarray(x)) for x in lists]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(decoded, pa.string())], names=[*batch.schema.names, "decoded"]
            )

    return kept.mapInArrow(run, schema)


def digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of whole texts, encoded and decoded again."""
    back = decode(encode(docs.select("doc_id", "text"), path).drop("text"), path)
    return back.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
