"""Near-duplicates by SimHash, found with tables of pivot distances.

The 64 bits are cut into blocks, and each fingerprint's Hamming distances to
reference fingerprints are computed once, block by block: its row of the distance
table, which is stored. By the triangle inequality two fingerprints differ within a
block by no less than the largest difference of the block's coordinates, and in all
by no less than the sum of these over the blocks. A pair for which that is more than
``max_bits`` is dropped unseen; the survivors are compared bit by bit.

The table also says who meets: of ``max_bits`` + e blocks at least e are free of
differences, and all their coordinates are equal. Fingerprints meet once for each
choice of e blocks, in cells keyed by those coordinates. e grows with the number of
fingerprints, so that a cell of unrelated ones stays small at any size.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seatwise.llm.common import components, local_roots, mix, stored

SHINGLE_WORDS = 4
MAX_BITS = 4
#: XXH64's seed, fixed by the fingerprints' definition.
SEED = 42
#: Reference fingerprints of the distance table; the distances to them in a block
#: are the bytes of one long.
PIVOTS = 8
#: Blocks that are equal for a meeting, at least.
EQUAL_BLOCKS = 2
#: Fingerprints of one cell compared with each other at a time.
BLOCK_ROWS = 1024
#: Cells up to this size are compared many at a time.
SMALL_CELL = 64
#: A larger cell is cut into parts, whose pairs are compared apart.
CELL_ROWS = 8192
#: Shingles hashed before their bits are added up.
HASH_ROWS = 1 << 15


def fingerprint(text: str | None, width: int = SHINGLE_WORDS) -> int:
    """Bits that are set in more than half of the shingles' hashes.

    Words are runs free of ASCII white space, A-Z in lower case. Too few words
    make one shingle; none, or a null text, give zero.
    """
    from xxhash import xxh64_intdigest

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.array([len(w) + 1 for w in words], dtype=np.int64)) - 1
    n = max(1, len(words) - width + 1)
    firsts = [0, *(ends[: n - 1] + 1).tolist()]
    lasts = ends[min(width, len(words)) - 1 :].tolist()
    votes = np.zeros(64, dtype=np.int64)
    for at in range(0, n, HASH_ROWS):
        hashes = np.array(
            [
                xxh64_intdigest(joined[a:b], SEED)
                for a, b in zip(firsts[at : at + HASH_ROWS], lasts[at : at + HASH_ROWS])
            ],
            dtype="<u8",
        )
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(axis=0, dtype=np.int64)
    return sum(1 << i for i in np.flatnonzero(votes * 2 > n).tolist())


def _fingerprints(width: int, kept: Sequence[str] = ()):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = np.array([fingerprint(t, width) for t in batch["text"]], dtype=np.uint64)
            yield pd.DataFrame(
                {"doc_id": batch["doc_id"].astype("Int64"), "fp": found.view(np.int64)}
                | {c: batch[c] for c in kept}
            )

    return run


def fingerprints(docs: DataFrame, width: int = SHINGLE_WORDS) -> DataFrame:
    """``(doc_id, fp)``, the fingerprint as a signed long."""
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    return texts.mapInPandas(_fingerprints(width), "doc_id long, fp long")


def equal_blocks(n: int, max_bits: int) -> int:
    """Blocks to be equal, so that ``n`` unrelated fingerprints rarely share a cell."""
    equal = EQUAL_BLOCKS
    while 64 * equal // (max_bits + equal) < n.bit_length() and max_bits + equal < 64:
        equal += 1
    return equal


def blocks(max_bits: int, equal: int = EQUAL_BLOCKS) -> list[int]:
    """Bit masks of ``max_bits + equal`` blocks: ``equal`` at least stay the same."""
    n = max_bits + equal
    edges = [round(64 * i / n) for i in range(n + 1)]
    return [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]


def pivot_distances(fps: np.ndarray, masks: Sequence[int]) -> np.ndarray:
    """Distances to the pivots in each block, as rows x blocks x pivots."""
    pivots = mix(np.arange(1, PIVOTS + 1, dtype=np.uint64))
    apart = fps[:, None] ^ pivots[None, :]
    parts = [np.bitwise_count(apart & np.uint64(mask)) for mask in masks]
    return np.stack(parts, axis=1).astype(np.int8)


def _distance_rows(masks: Sequence[int]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            fps = batch["fp"].to_numpy()
            table = pivot_distances(fps.view(np.uint64), masks)
            packed = np.ascontiguousarray(table).view(np.int64)[..., 0]
            yield pd.DataFrame({"fp": fps} | {f"d{b}": packed[:, b] for b in range(len(masks))})

    return run


def distance_table(distinct: DataFrame, masks: Sequence[int]) -> DataFrame:
    """``(fp, d0, d1, ...)``, the distances to a block's pivots as bytes of a long."""
    schema = ", ".join(["fp long", *(f"d{b} long" for b in range(len(masks)))])
    return distinct.select("fp").mapInPandas(_distance_rows(masks), schema)


def survivors(table: np.ndarray, i: np.ndarray, j: np.ndarray, max_bits: int) -> np.ndarray:
    """Which of the pairs the distances do not tell apart, a block at a time."""
    left = np.arange(len(i))
    least = np.zeros(len(i), dtype=np.int16)
    for b in range(table.shape[1]):
        if not len(left):
            break
        least += np.abs(table[i[left], b] - table[j[left], b]).max(axis=1)
        near = least <= max_bits
        left, least = left[near], least[near]
    return left


def cell_links(fps: np.ndarray, table: np.ndarray, max_bits: int) -> tuple:
    """Index pairs of fingerprints within ``max_bits``, a block of rows at a time."""
    left, right = [], []
    for at in range(0, len(fps), BLOCK_ROWS):
        rows = np.arange(at, min(at + BLOCK_ROWS, len(fps)))
        for to in range(at, len(fps), BLOCK_ROWS):
            cols = np.arange(to, min(to + BLOCK_ROWS, len(fps)))
            i, j = (x.ravel() for x in np.meshgrid(rows, cols, indexing="ij"))
            i, j = i[i < j], j[i < j]
            near = survivors(table, i, j, max_bits)
            i, j = i[near], j[near]
            close = np.bitwise_count(fps[i] ^ fps[j]) <= max_bits
            left.append(i[close])
            right.append(j[close])
    return np.concatenate(left), np.concatenate(right)


def small_cell_links(
    fps: np.ndarray, table: np.ndarray, sizes: np.ndarray, max_bits: int
) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs within ``max_bits`` in each of many cells that follow each other.

    Each row is paired with the next one of its cell, then the one after, and so on.
    """
    rest = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(fps)) - 1
    left, right = [], []
    for step in range(1, int(sizes.max(initial=0))):
        i = np.flatnonzero(rest >= step)
        i = i[survivors(table, i, i + step, max_bits)]
        i = i[np.bitwise_count(fps[i] ^ fps[i + step]) <= max_bits]
        left.append(i)
        right.append(i + step)
    if not left:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(left), np.concatenate(right)


def _star_links(max_bits: int, n_blocks: int):
    """Links of the cells of a partition sorted by cell, as stars."""

    def stars(fps: np.ndarray, left: np.ndarray, right: np.ndarray) -> pd.DataFrame:
        root = local_roots(len(fps), left, right)
        out = np.flatnonzero(root != np.arange(len(fps)))
        return pd.DataFrame({"a": fps[root[out]].view(np.int64), "b": fps[out].view(np.int64)})

    def found(parts: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pd.DataFrame]:
        if sum(len(fps) for fps, _ in parts) > 1:
            fps, rows = np.unique(np.concatenate([f for f, _ in parts]), return_index=True)
            table = np.concatenate([t for _, t in parts])[rows]
            yield stars(fps, *cell_links(fps, table, max_bits))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # The last cell of a batch may go on in the next one.
        held: list[tuple[np.ndarray, np.ndarray]] = []
        cell = None
        for batch in batches:
            cells = batch["cell"].to_numpy() ^ mix(
                batch["pair"].to_numpy().view(np.uint64), 99
            ).view(np.int64)
            fps = batch["fp"].to_numpy().view(np.uint64)
            if not len(cells):
                continue
            packed = np.stack([batch[f"d{b}"].to_numpy() for b in range(n_blocks)], axis=1)
            table = packed.view(np.int8).reshape(len(fps), n_blocks, PIVOTS)
            edges = np.flatnonzero(np.diff(cells)) + 1
            starts, ends = np.append(0, edges), np.append(edges, len(cells))
            if cells[0] != cell:
                yield from found(held)
                held = []
            held.append((fps[: ends[0]], table[: ends[0]]))
            if len(starts) > 1:
                yield from found(held)
                held = [(fps[starts[-1] :], table[starts[-1] :])]
            cell = cells[-1]
            # Most cells hold one fingerprint and cost nothing here.
            sizes = ends - starts
            sizes[[0, -1]] = 1
            for i in np.flatnonzero(sizes > SMALL_CELL):
                yield from found([(fps[starts[i] : ends[i]], table[starts[i] : ends[i]])])
            few = (sizes > 1) & (sizes <= SMALL_CELL)
            chosen = np.repeat(few, ends - starts)
            some = fps[chosen]
            yield stars(some, *small_cell_links(some, table[chosen], sizes[few], max_bits))
        yield from found(held)

    return run


def _parted(cells: DataFrame) -> DataFrame:
    """Cells with ``pair``: 0, or in a large cell each pair of parts a row is in.

    A row of part ``s`` of ``k`` meets part ``j`` in the pair of the two, so all
    pairs of rows meet, and no task holds more than two parts.
    """
    large = (
        cells.groupBy("cell")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") > CELL_ROWS)
        .select(F.col("cell").alias("large"), F.ceil(F.col("n") / CELL_ROWS).alias("k"))
    )
    mine = F.pmod(F.xxhash64("fp"), F.col("k"))
    pairs = F.transform(
        F.sequence(F.lit(0).cast("bigint"), F.col("k") - 1),
        lambda j: F.least(mine, j) * F.col("k") + F.greatest(mine, j) + 1,
    )
    alone = F.array(F.lit(0).cast("bigint"))
    return cells.join(large, F.col("cell") == F.col("large"), "left").select(
        *cells.columns, F.explode(F.when(F.col("k").isNull(), alone).otherwise(pairs)).alias("pair")
    )


def fingerprint_links(
    distinct: DataFrame, max_bits: int = MAX_BITS, equal: int | None = None
) -> DataFrame:
    """Links ``(a, b)`` that connect all distinct fingerprints within ``max_bits``.

    ``distinct`` is counted, so it should be a stored table. Within a cell links are
    reduced to stars, which connect the same fingerprints with fewer rows than there
    are pairs.
    """
    equal = equal or equal_blocks(distinct.count(), max_bits)
    masks = blocks(max_bits, equal)
    table = stored(distance_table(distinct, masks), "distances")
    keys = [
        F.xxhash64(F.lit(i), *(f"d{b}" for b in choice))
        for i, choice in enumerate(combinations(range(len(masks)), equal))
    ]
    cells = table.select(F.explode(F.array(*keys)).alias("cell"), *table.columns)
    met = (
        _parted(cells)
        .repartition("cell", "pair")
        .sortWithinPartitions("cell", "pair")
    )
    return met.mapInPandas(_star_links(max_bits, len(masks)), "a long, b long").distinct()


def near_duplicates(
    docs: DataFrame, width: int = SHINGLE_WORDS, max_bits: int = MAX_BITS
) -> DataFrame:
    """``(doc_id, fingerprint, component_id)``, one row for each input row.

    The component is the smallest ``doc_id`` reached over links between
    fingerprints that differ in at most ``max_bits`` bits. Equal texts, null and
    empty texts included, share a fingerprint and so a component. A null
    ``doc_id`` gets its component's smallest id, null where there is none. Texts
    are hashed whole whatever their length, repeated rows each have their row, no
    rows give none. Other columns are left aside whatever their names.
    """
    found = stored(fingerprints(docs, width), "fingerprints")
    first = stored(found.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    groups = components(fingerprint_links(first, max_bits))
    joined = first.join(groups, first.fp == groups.node, "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("part")
    )
    least = joined.groupBy("part").agg(F.min("first").alias("component_id"))
    by_fp = joined.join(least, "part").select("fp", "component_id")
    return found.join(by_fp, "fp").select(
        "doc_id",
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id",
    )


def keep_first(docs: DataFrame, width: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """One row of each group of near-duplicates, all columns as they are.

    Groups go by the fingerprints alone, whatever ids rows share. The row of the
    smallest ``doc_id`` stays, an absent one last, of several with that id the one
    whose text and then whose whole row has the smallest digest. Copies of a row
    are one group, and so are null and empty texts. No rows give none.
    """
    columns = docs.columns
    row = F.md5(F.to_json(F.struct(*columns)).cast("binary"))
    text = F.col("text").cast("string")
    told = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        text.alias("text"),
        F.md5(F.coalesce(text, F.lit("")).cast("binary")).alias("text_digest"),
        row.alias("row_digest"),
    )
    rows = stored(
        told.mapInPandas(
            _fingerprints(width, ["text_digest", "row_digest"]),
            "doc_id long, fp long, text_digest string, row_digest string",
        ),
        "fingerprints",
    )
    distinct = stored(rows.select("fp").distinct(), "distinct")
    groups = components(fingerprint_links(distinct, max_bits))
    part = F.coalesce("component", "fp")
    first = (
        rows.join(groups, F.col("fp") == F.col("node"), "left")
        .groupBy(part.alias("part"))
        .agg(
            F.min(
                F.struct(F.isnull("doc_id").alias("absent"), "doc_id", "text_digest", "row_digest")
            ).alias("first")
        )
        .select(F.col("first.row_digest").alias("_kept"))
    )
    kept = docs.withColumn("_digest", row).join(first, F.col("_digest") == F.col("_kept"), "left_semi")
    # Copies alike in every column are the same row, whichever of them stays.
    return kept.dropDuplicates(["_digest"]).select(*columns)
