"""URL rules looked up in a sorted, memory-mapped array of 64-bit digests.

A rule has a host, a path prefix and a verdict. It fits its host, every subdomain and every URL
whose path starts with its prefix; of the rules that fit a URL the longest decides. The list is a
file of sorted XXH64 keys with the full strings beside them: tasks map it, probe a whole batch by
one binary search and compare the stored string of every key met, so a collision never decides.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyarrow import fs
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir
from .common import column, slices

RULES = "host string, path string, verdict string"
ALLOW, BLOCK = "allow", "block"
# Lists up to this many rules and bytes of text go to the executors as a file; larger ones are joined.
MAPPED_RULES = 5_000_000
MAPPED_BYTES = 256 << 20
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """From the first :// up to /, ?, # or the end, A-Z lower-cased; empty without ://."""
    found = F.regexp_extract(url, r"://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ? or #; empty without ://."""
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def known_rules(rules: DataFrame) -> DataFrame:
    """(host, path, verdict), one row per host and path; block wins over allow.

    Null hosts and paths are empty, hosts are lower-cased; rows whose verdict is neither allow nor
    block (null too) are left out. An empty host fits URLs without a host only.
    """
    return (
        rules.select(
            F.translate(F.coalesce("host", F.lit("")), _UPPER, _LOWER).alias("host"),
            F.coalesce("path", F.lit("")).alias("path"),
            F.col("verdict"),
        )
        .where(F.col("verdict").isin(ALLOW, BLOCK))
        .groupBy("host", "path")
        .agg(F.max("verdict").alias("verdict"))
    )


def digests(values: list[bytes], bits: int = 64) -> np.ndarray:
    """XXH64 of every value; fewer bits only to make collisions in tests."""
    keys = np.fromiter((xxhash.xxh64_intdigest(v) for v in values), dtype=np.uint64, count=len(values))
    return keys if bits == 64 else keys & np.uint64((1 << bits) - 1)


class DigestArray:
    """Strings sorted by digest, mapped from a file: keys, ends of the strings, the strings."""

    def __init__(self, raw: np.ndarray, n: int, n_bytes: int, bits: int) -> None:
        self.keys = raw[: 8 * n].view(np.uint64)
        self.ends = raw[8 * n : 16 * n].view(np.uint64)
        self.blob = raw[16 * n : 16 * n + n_bytes]
        self.bits = bits

    def text(self, i: int) -> bytes:
        start = int(self.ends[i - 1]) if i else 0
        return self.blob[start : int(self.ends[i])].tobytes()

    def find(self, values: list[bytes]) -> np.ndarray:
        """Index of every value, -1 where it isn't in the array."""
        keys = digests(values, self.bits)
        first = np.searchsorted(self.keys, keys, "left")
        last = np.searchsorted(self.keys, keys, "right")
        out = np.full(len(values), -1, dtype=np.int64)
        for k in np.flatnonzero(last > first):
            out[k] = next((i for i in range(first[k], last[k]) if self.text(i) == values[k]), -1)
        return out

    @staticmethod
    def pack(values: list[bytes], bits: int) -> tuple[np.ndarray, bytes]:
        """The order of the values by digest, and keys, ends and strings in that order."""
        keys = digests(values, bits)
        order = np.argsort(keys, kind="stable")
        ends = np.cumsum([len(values[i]) for i in order], dtype=np.uint64)
        return order, keys[order].tobytes() + ends.tobytes() + b"".join(values[i] for i in order)


def _pad(data: bytes) -> bytes:
    return data + b"\0" * (-len(data) % 8)


class RuleFile:
    """The mapped list: an array of hosts with their prefix lengths, an array of host and path.

    The file starts with its sizes: hosts, bytes of hosts, prefix lengths, rules, bytes of rules,
    bits. Then follow the host array, the ends of each host's run of lengths, the lengths, the rule
    array and per rule the bytes of its host, its characters and its verdict.
    """

    def __init__(self, path: str) -> None:
        raw = np.memmap(path, dtype=np.uint8, mode="r")
        n_hosts, host_bytes, n_lengths, n_rules, rule_bytes, bits = raw[:48].view(np.int64).tolist()
        at = 48

        def part(size: int) -> np.ndarray:
            nonlocal at
            out, at = raw[at : at + size], at + size + (-size % 8)
            return out

        self.hosts = DigestArray(part(16 * n_hosts + host_bytes), n_hosts, host_bytes, bits)
        self.runs = part(8 * n_hosts).view(np.int64)
        self.lengths = part(8 * n_lengths).view(np.int64)
        self.rules = DigestArray(part(16 * n_rules + rule_bytes), n_rules, rule_bytes, bits)
        self.facts = part(24 * n_rules).view(np.int64).reshape(-1, 3)
        self.longest_host = int(np.diff(self.hosts.ends, prepend=np.uint64(0)).max()) if n_hosts else -1

    @staticmethod
    def build(rows: list[tuple[str, str, str]], bits: int = 64) -> bytes:
        pairs = [(h.encode(), p.encode()) for h, p, _ in rows]
        lengths: dict[bytes, set[int]] = {}
        for host, path in pairs:
            lengths.setdefault(host, set()).add(len(path))
        hosts = list(lengths)
        host_order, host_part = DigestArray.pack(hosts, bits)
        runs = [sorted(lengths[hosts[i]]) for i in host_order]
        texts = [h + b"\0" + p for h, p in pairs]
        rule_order, rule_part = DigestArray.pack(texts, bits)
        facts = [(len(pairs[i][0]), len(rows[i][0]) + len(rows[i][1]), rows[i][2] == BLOCK) for i in rule_order]
        sizes = [len(hosts), sum(map(len, hosts)), sum(map(len, runs)), len(rows), sum(map(len, texts)), bits]
        parts = [
            np.array(sizes, np.int64).tobytes(),
            host_part,
            np.cumsum([len(r) for r in runs], dtype=np.int64).tobytes(),
            np.array([x for r in runs for x in r], np.int64).tobytes(),
            rule_part,
            np.array(facts, np.int64).tobytes(),
        ]
        return b"".join(map(_pad, parts))

    def suffixes(self, host: bytes) -> Iterator[bytes]:
        """The host and its parent domains, as far as a rule's host can be that long."""
        start = max(0, len(host) - self.longest_host)
        if start == 0:
            yield host
            start = 1
        at = host.find(b".", start - 1)
        while at >= 0:
            yield host[at + 1 :]
            at = host.find(b".", at + 1)

    def hosts_with_rules(self, hosts: list[bytes]) -> list[list[int]]:
        """For each host the numbers of those in the list that it equals or lies below."""
        owners, values = [], []
        for i, host in enumerate(hosts):
            own = list(self.suffixes(host)) if self.longest_host >= 0 else []
            owners += [i] * len(own)
            values += own
        out: list[list[int]] = [[] for _ in hosts]
        for i, found in zip(owners, self.hosts.find(values).tolist(), strict=True):
            if found >= 0:
                out[i].append(found)
        return out

    def longest(self, known: list[list[int]], paths: list[bytes]) -> np.ndarray:
        """Number of the longest rule that fits each row, -1 without one."""
        owners, values = [], []
        for i, (numbers, path) in enumerate(zip(known, paths, strict=True)):
            for k in numbers:
                head = self.hosts.text(k) + b"\0"
                for size in self.lengths[(self.runs[k - 1] if k else 0) : self.runs[k]].tolist():
                    if size <= len(path):
                        owners.append(i)
                        values.append(head + path[:size])
        best = np.full(len(paths), -1, dtype=np.int64)
        for i, found in zip(owners, self.rules.find(values).tolist(), strict=True):
            if found >= 0 and (best[i] < 0 or self.rank(found) > self.rank(best[i])):
                best[i] = found
        return best

    def rank(self, rule: int) -> tuple[int, int]:
        """Characters of the rule, then bytes of its host."""
        host, size, _ = self.facts[rule].tolist()
        return size, host

    def shown(self, rule: int) -> tuple[str | None, str | None]:
        if rule < 0:
            return None, None
        host, path = self.rules.text(rule).split(b"\0", 1)
        return (host + path).decode(), BLOCK if self.facts[rule][2] else ALLOW


def _publish(spark: SparkSession, data: bytes) -> str:
    """Write the list into the shared folder and have Spark bring it to every executor."""
    name = f"url-rules-{uuid.uuid4().hex[:12]}.bin"
    folder = f"{shared_dir(spark).rstrip('/')}/llm"
    store, inside = fs.FileSystem.from_uri(folder)
    store.create_dir(inside, recursive=True)
    with store.open_output_stream(f"{inside}/{name}") as out:
        out.write(data)
    spark.sparkContext.addFile(f"{folder}/{name}")
    return name


def judge(
    pages: DataFrame,
    rules: DataFrame,
    *,
    keys: tuple[str, ...] = ("page_id",),
    url: str = "url",
    otherwise: str = ALLOW,
    bits: int = 64,
    mapped_rules: int = MAPPED_RULES,
) -> DataFrame:
    """(keys, host, path, rule, verdict): one row per page, repeated rows and null keys included.

    ``rule`` is the longest rule that fits, as host and path in one string, null without one; then
    the verdict is ``otherwise``: what isn't in the list is allowed by default. Length is counted in
    characters; of equally long rules the one with the longer host decides. A null URL or one
    without :// has an empty host and path. Columns of the pages other than the keys and the URL
    are ignored.

    The list is measured first. Up to MAPPED_RULES rules and MAPPED_BYTES of text it becomes one
    file that Spark brings to the executors; nothing is shuffled then, so a frequent host costs as
    much as any other. A longer list is joined, see ``joined``.
    """
    spark = pages.sparkSession
    own = known_rules(rules)
    size = own.agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length("host") + F.octet_length("path")), F.lit(0))
    ).first()
    located = pages.select(*keys, host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    if size[0] > mapped_rules or size[1] > MAPPED_BYTES:
        return joined(located, own, keys, otherwise)
    name = _publish(spark, RuleFile.build([tuple(r) for r in own.collect()], bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rule_file = RuleFile(SparkFiles.get(name))
        for batch in slices(batches, 4096):
            hosts = column(batch, "host").dictionary_encode()
            by_host = rule_file.hosts_with_rules([h.encode() for h in hosts.dictionary.to_pylist()])
            known = [by_host[i] for i in hosts.indices.to_pylist()]
            paths = [p.encode() if k else b"" for k, p in zip(known, column(batch, "path").to_pylist(), strict=True)]
            shown = [rule_file.shown(i) for i in rule_file.longest(known, paths)]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array([r for r, _ in shown], pa.string()),
                    pa.array([v or otherwise for _, v in shown], pa.string()),
                ],
                names=[*batch.schema.names, "rule", "verdict"],
            )

    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in located.schema.fields)
    return located.mapInArrow(run, f"{types}, rule string, verdict string")


def joined(located: DataFrame, rules: DataFrame, keys: tuple[str, ...], otherwise: str) -> DataFrame:
    """The same rows for a list too long to be mapped: digests and full strings joined by Spark.

    Every different host and path is looked up once. Its parent domains, as deep as any in the
    list, meet the hosts of the list, which bring the prefix lengths worth trying; the prefixes
    meet the rules.
    """
    deepest = rules.agg(F.coalesce(F.max(F.size(F.split("host", r"\."))), F.lit(1))).first()[0]
    ruled = rules.withColumn("key", F.xxhash64("host", "path"))
    hosts = rules.groupBy("host").agg(F.collect_set(F.length("path")).alias("sizes"))
    labels = F.split("host", r"\.")
    below = F.transform(
        F.sequence(F.greatest(F.lit(1), F.size(labels) - F.lit(deepest - 1)), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )
    places = located.select("host", "path").distinct()
    prefixes = (
        places.select("host", "path", F.explode(F.array_distinct(below)).alias("own"))
        .join(hosts.select(F.col("host").alias("own"), "sizes"), "own")
        .select("host", "path", "own", F.explode("sizes").alias("size"))
        .where(F.col("size") <= F.length("path"))
        .select("host", "path", "own", F.expr("substring(path, 1, size)").alias("head"))
        .withColumn("key", F.xxhash64("own", "head"))
    )
    fits = prefixes.join(
        ruled.select("key", F.col("host").alias("own"), F.col("path").alias("head"), "verdict"), ["key", "own", "head"]
    )
    best = fits.groupBy("host", "path").agg(
        F.max_by(
            F.struct(F.concat("own", "head").alias("rule"), "verdict"),
            F.struct(F.length("own") + F.length("head"), F.octet_length("own")),
        ).alias("best")
    )
    return located.join(best, ["host", "path"], "left").select(
        *keys, "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(otherwise)).alias("verdict")
    )
