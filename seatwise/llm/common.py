"""What several operators share: stored tables, components, word hashes."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seatwise.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows written to the cluster's shared folder and read back.

    Cuts the lineage in a way that survives lost executors.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``edges(a, b)``, ids are longs.

    The component is the smallest node that can be reached. Each round takes the
    smallest label among the neighbours and then the label of that label, so the
    number of rounds grows with the logarithm of a chain's length. Tables only
    meet in joins; the driver sees one count a round.
    """
    forward = edges.where("a <> b").select(F.col("a").alias("src"), F.col("b").alias("dst"))
    backward = forward.select(F.col("dst").alias("src"), F.col("src").alias("dst"))
    links = stored(forward.union(backward).distinct(), "links")
    labels = stored(
        links.groupBy(F.col("src").alias("node"))
        .agg(F.min("dst").alias("near"))
        .select("node", F.least("node", "near").alias("label"), F.lit(True).alias("moved")),
        "labels",
    )
    while not labels.where("moved").isEmpty():
        known = labels.select("node", "label")
        near = (
            links.join(known, links.dst == known.node)
            .groupBy(F.col("src").alias("node"))
            .agg(F.min("label").alias("near"))
        )
        least = known.join(near, "node").select(
            "node", "label", F.least("label", "near").alias("found")
        )
        target = known.select(F.col("node").alias("found"), F.col("label").alias("beyond"))
        labels = stored(
            least.join(target, "found").select(
                "node",
                F.least("found", "beyond").alias("label"),
                (F.least("found", "beyond") < F.col("label")).alias("moved"),
            ),
            "labels",
        )
    return labels.select("node", F.col("label").alias("component"))


def local_roots(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The smallest index each of ``n`` nodes reaches over the links given."""
    root = np.arange(n)
    while len(left):
        low = np.minimum(root[left], root[right])
        before = root.copy()
        np.minimum.at(root, root[left], low)
        np.minimum.at(root, root[right], low)
        np.minimum.at(root, left, low)
        np.minimum.at(root, right, low)
        root = root[root]
        if np.array_equal(root, before):
            break
    while not np.array_equal(root, root[root]):
        root = root[root]
    return root


def chunks(sizes: Iterable[int], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive items whose sizes add up to about ``most``."""
    start = total = 0
    end = 0
    for end, size in enumerate(sizes, 1):
        total += size
        if total >= most:
            yield start, end
            start, total = end, 0
    if start < end:
        yield start, end


#: An odd multiplier; its inverse modulo 2^64 undoes a shift of the rolling sum.
BASE = 0x9E3779B97F4A7C15
BASE_INVERSE = pow(BASE, -1, 1 << 64)
CHUNK_BYTES = 1 << 20


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    x = x + np.uint64((seed * 0xD1342543DE82EF95 + 0x9E3779B97F4A7C15) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n + 1, base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out)


def byte_table(fold: bytes | None = None) -> np.ndarray:
    codes = np.arange(256, dtype=np.uint64)
    if fold is not None:
        codes = np.frombuffer(fold, dtype=np.uint8).astype(np.uint64)
    return mix(codes, 7)


class WordHasher:
    """64-bit hashes of the words of many texts by whole-array arithmetic.

    ``is_word`` marks the bytes that make up words, ``fold`` maps bytes before
    hashing (lower case, say). Texts are worked on a megabyte at a time, cut
    between words, so a very long text needs memory for its hashes only.
    """

    def __init__(self, is_word: np.ndarray, fold: bytes | None = None):
        self.is_word = is_word
        self.codes = byte_table(fold)
        self.up = powers(BASE, 0)
        self.down = powers(BASE_INVERSE, 0)

    def _grow(self, n: int) -> None:
        if len(self.up) <= n:
            self.up, self.down = powers(BASE, n), powers(BASE_INVERSE, n)

    def spans(self, data: bytes) -> tuple[np.ndarray, np.ndarray]:
        """First byte of each word, and the byte after it."""
        inside = np.zeros(len(data) + 2, dtype=np.int8)
        inside[1:-1] = self.is_word[np.frombuffer(data, dtype=np.uint8)]
        change = np.diff(inside)
        return np.flatnonzero(change == 1), np.flatnonzero(change == -1)

    def one(self, data: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Hashes and first bytes of the words of one piece."""
        starts, ends = self.spans(data)
        self._grow(len(data))
        raw = np.frombuffer(data, dtype=np.uint8)
        sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(self.codes[raw] * self.up[: len(raw)], out=sums[1:])
        found = (sums[ends] - sums[starts]) * self.down[starts]
        return mix(found + (ends - starts).astype(np.uint64)), starts

    def many(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all words in order, and the number of words of each text."""
        hashes, counts = [], np.zeros(len(texts), dtype=np.int64)
        for first, last in chunks((len(t) + 1 for t in texts), CHUNK_BYTES):
            if last - first == 1 and len(texts[first]) > 2 * CHUNK_BYTES:
                for piece in self._pieces(texts[first]):
                    found, _ = self.one(piece)
                    hashes.append(found)
                    counts[first] += len(found)
                continue
            found, starts = self.one(b"\n".join(texts[first:last]))
            edges = np.cumsum([len(t) + 1 for t in texts[first:last]])
            counts[first:last] = np.diff(np.searchsorted(starts, edges), prepend=0)
            hashes.append(found)
        return np.concatenate(hashes) if hashes else np.zeros(0, np.uint64), counts

    def _pieces(self, data: bytes) -> Iterator[bytes]:
        at = 0
        while at < len(data):
            end = min(at + CHUNK_BYTES, len(data))
            while end < len(data) and self.is_word[data[end]]:
                end += 1
            yield data[at:end]
            at = end


def window_hashes(words: np.ndarray, width: int, seed: int = 0) -> np.ndarray:
    """Hash of each run of ``width`` consecutive words."""
    if len(words) < width:
        return np.zeros(0, dtype=np.uint64)
    total = np.zeros(len(words) - width + 1, dtype=np.uint64)
    for i in range(width):
        total = total * np.uint64(BASE) + words[i : len(words) - width + 1 + i]
    return mix(total, seed)
