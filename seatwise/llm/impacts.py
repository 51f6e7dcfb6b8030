"""Exact top-k search by an impact-ordered index read score at a time.

The index is cut into shards of rows dealt evenly. A shard holds its postings
(row, dimension, value) in segments of equal quantised impact, that is, values
whose sizes lie between two powers of two, largest first. Queries are dealt into
blocks; all shards stream past a block, each shard's segments in falling order of
impact, and add to the scores of all its rows for all queries of the block.

After a segment the rest of a row's score is at most the length of what the row
still has to give times the length of the query. A row whose score and rest stay
below the k-th best that is proven already is out. Reading stops when few rows
are left, all others being proven out, and those are scored anew from their whole
vectors. No row is dropped for any other reason.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seatwise.llm.common import stored

SCALE = 64
TOP = 20
EVERY = 20
#: Rows of a shard and queries of a block, what a task holds at a time.
SHARD_ROWS = 4096
BLOCK_QUERIES = 4096
#: Queries of a block scored together; bounds the table of scores in memory.
TOGETHER = 256
#: Reading of segments stops once at most this share of the scores is still open.
OPEN_SHARE = 1 / 64
#: Whole numbers up to this are exact as doubles.
EXACT = 2**53
MOST, LEAST = 2**63 - 1, -(2**63)


def quantised(vector: Column, scale: int = SCALE) -> Column:
    """Whole numbers below each component times ``scale``; at the ends of a long."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale))))


def usable(vector: Column) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == math.inf))
    return vector.isNotNull() & ~bad


def segments(x: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Postings by falling impact: a table with the values of that impact, zero
    elsewhere, and the length of what each row has left behind it."""
    size = np.abs(x)
    level = np.where(size > 0, np.floor(np.log2(np.maximum(size, 1))) + 1, 0)
    out = []
    for at in sorted(set(np.unique(level)) - {0}, reverse=True):
        rest = np.where(level < at, x, 0)
        out.append((np.where(level == at, x, 0), np.sqrt((rest * rest).sum(axis=1))))
    return out


def wide(x: np.ndarray, y: np.ndarray) -> bool:
    """Whether scores may be too large for doubles to be exact."""
    most = [max((abs(int(v)) for v in (z.min(), z.max())), default=0) if z.size else 0 for z in (x, y)]
    return most[0] * most[1] * max(x.shape[1], 1) >= EXACT


def exact_scores(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Inner products of rows of ``x`` with rows of the same place in ``y``, as longs."""
    if not wide(x, y):
        return (x * y).sum(axis=1)
    whole = (x.astype(object) * y.astype(object)).sum(axis=1)
    return np.array([min(max(int(v), LEAST), MOST) for v in whole], dtype=np.int64)


class Best:
    """The best rows so far of each query of a block, in order."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.query = np.zeros(0, np.int64)
        self.score = np.zeros(0, np.int64)
        self.vec = np.zeros(0, np.int64)
        self.absent = np.zeros(0, bool)
        self.row = np.zeros(0, np.int64)
        self.proven = np.full(queries, -np.inf)

    def add(self, query, score, vec, absent, row) -> None:
        query = np.concatenate([self.query, query])
        score = np.concatenate([self.score, score])
        vec = np.concatenate([self.vec, vec])
        absent = np.concatenate([self.absent, absent])
        row = np.concatenate([self.row, row])
        by = np.lexsort((row, vec, absent, ~score, query))
        first = np.searchsorted(query[by], np.arange(len(self.proven)))
        place = np.arange(len(by)) - first[query[by]]
        by, place = by[place < self.k], place[place < self.k]
        self.query, self.score, self.vec = query[by], score[by], vec[by]
        self.absent, self.row = absent[by], row[by]
        last = place == self.k - 1
        kth = self.score[last].astype(np.float64)
        lower = np.where(np.abs(kth) < EXACT, kth, np.nextafter(kth, -np.inf))
        self.proven[self.query[last]] = lower


def score_shard(best: Best, q: np.ndarray, q_row: np.ndarray, shard: dict) -> None:
    """Reads a shard's segments for all queries and keeps whoever belongs to the best."""
    x, k = shard["x"], best.k
    d = max(q.shape[1], x.shape[1])
    q = np.pad(q, ((0, 0), (0, d - q.shape[1])))
    x = np.pad(x, ((0, 0), (0, d - x.shape[1])))
    plain = not wide(q, x)
    read = [(np.pad(v, ((0, 0), (0, d - v.shape[1]))).T, rest) for v, rest in shard["segments"]]
    for at in range(0, len(q), TOGETHER):
        some = q[at : at + TOGETHER].astype(np.float64)
        own = q_row[at : at + TOGETHER]
        open_ = own[:, None] != shard["row"][None, :]
        if plain:
            length = np.sqrt((some * some).sum(axis=1))[:, None]
            total = np.zeros((len(some), len(x)))
            proven = best.proven[at : at + TOGETHER]
            # Later shards have the k-th best of those before them to go by.
            unknown = len(x) > k and bool(np.isinf(proven).any())
            for values, rest in read:
                total += some @ values
                # Room for the rounding of the lengths; scores themselves are exact.
                room = length * rest[None, :] * (1 + 1e-9)
                if unknown:
                    sure = np.where(open_, total - room, -np.inf)
                    kth = np.partition(sure, len(x) - k, axis=1)[:, len(x) - k]
                    proven = np.maximum(proven, kth)
                open_ &= total + room >= proven[:, None]
                if np.count_nonzero(open_) <= OPEN_SHARE * open_.size:
                    break
        i, j = np.nonzero(open_)
        for a in range(0, len(i), 1 << 18):
            part = slice(a, a + (1 << 18))
            score = exact_scores(q[at + i[part]], x[j[part]])
            keep = score >= best.proven[at + i[part]]
            here = j[part][keep]
            best.add(
                at + i[part][keep], score[keep], shard["vec"][here], shard["absent"][here],
                shard["row"][here],
            )


def _lists(batch) -> np.ndarray:
    """A table of long vectors from lists; shorter ones are filled up with zeros."""
    sizes = np.array([len(v) for v in batch], dtype=np.int64)
    out = np.zeros((len(sizes), int(sizes.max(initial=0))), dtype=np.int64)
    if len(sizes):
        inside = np.arange(out.shape[1])[None, :] < sizes[:, None]
        out[inside] = np.concatenate([np.asarray(v, dtype=np.int64) for v in batch])
    return out


SHARD = "shard long, vec binary, absent binary, row binary, width int, x binary, kind string"


def _index(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Shards of a partition's rows; values are stored in as few bytes as they need."""

    def shard(rows: pd.DataFrame) -> pd.DataFrame:
        x = _lists(rows["x"])
        kind = np.min_scalar_type(min(int(x.min(initial=0)), -1 - int(x.max(initial=0))))
        return pd.DataFrame(
            {
                "shard": [int(rows["row"].iloc[0])],
                "vec": [rows["vec"].to_numpy(np.int64).tobytes()],
                "absent": [rows["absent"].to_numpy(bool).tobytes()],
                "row": [rows["row"].to_numpy(np.int64).tobytes()],
                "width": [x.shape[1]],
                "x": [x.astype(kind).tobytes()],
                "kind": [kind.str],
            }
        )

    held: list[pd.DataFrame] = []
    for batch in batches:
        for at in range(0, len(batch), SHARD_ROWS):
            held.append(batch.iloc[at : at + SHARD_ROWS])
            if sum(map(len, held)) >= SHARD_ROWS:
                together = pd.concat(held)
                yield shard(together.iloc[:SHARD_ROWS])
                held = [together.iloc[SHARD_ROWS:]]
    if sum(map(len, held)):
        yield shard(pd.concat(held))


def _opened(row) -> dict:
    ids = np.frombuffer(row.row, dtype=np.int64)
    x = np.frombuffer(row.x, dtype=np.dtype(row.kind)).astype(np.int64)
    x = x.reshape(len(ids), int(row.width))
    return {
        "x": x,
        "row": ids,
        "vec": np.frombuffer(row.vec, dtype=np.int64),
        "absent": np.frombuffer(row.absent, dtype=bool),
        "segments": segments(x.astype(np.float64)),
    }


FOUND = "query_row long, query_id long, vec_id long, row long, score long"


def _search(k: int):
    """Blocks of queries met by shards: rows come by block and slice, queries first."""

    def found(best: Best, rows: np.ndarray, ids: np.ndarray) -> pd.DataFrame:
        vec = pd.array(best.vec, dtype="Int64")
        vec[best.absent] = pd.NA
        return pd.DataFrame(
            {
                "query_row": rows[best.query], "query_id": ids[best.query],
                "vec_id": vec, "row": best.row, "score": best.score,
            }
        )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, held, best = None, [], None
        q = q_row = q_id = None
        for batch in batches:
            for r in batch.itertuples(index=False):
                if (r.block, r.slice) != at:
                    if best is not None:
                        yield found(best, q_row, q_id)
                    at, held, best = (r.block, r.slice), [], None
                if r.shard < 0:
                    held.append((int(r.q_row), int(r.q_id), r.q))
                    continue
                if best is None:
                    if not held:
                        continue
                    q = _lists([v for _, _, v in held])
                    q_row = np.array([v for v, _, _ in held], dtype=np.int64)
                    q_id = np.array([v for _, v, _ in held], dtype=np.int64)
                    best = Best(len(held), k)
                score_shard(best, q, q_row, _opened(r))
        if best is not None:
            yield found(best, q_row, q_id)

    return run


def top_matches(
    vectors: DataFrame, k: int = TOP, every: int = EVERY, scale: int = SCALE
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` best rows for each query.

    ``vectors`` has ``vec_id`` and ``embedding``; other columns are left aside
    whatever their names. Queries are the rows whose id is divisible by ``every``,
    candidates all rows but the query's own, the score the inner product of the
    vectors times ``scale`` rounded down. Ties go to the smaller id, an absent id
    last. Null vectors and such with null or non-finite components take no part.
    Missing components of a shorter or empty vector count as zero. A repeated row
    is a candidate, and a query, of its own. Components and scores beyond a long
    are its largest or smallest value. Without rows or queries nothing comes back.
    """
    rows = stored(
        vectors.select(
            F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("v")
        )
        .where(usable(F.col("v")))
        .select("vec_id", quantised(F.col("v"), scale).alias("x"))
        .withColumn("row", F.monotonically_increasing_id()),
        "quantised",
    )
    counted = rows.agg(
        F.count("*").alias("n"), F.count_if(F.col("vec_id") % every == 0).alias("q")
    ).first()
    # No column that Python reads is null, or its numbers would become doubles there.
    spread = rows.select(
        "x", "row", F.coalesce("vec_id", F.lit(0)).alias("vec"), F.isnull("vec_id").alias("absent")
    ).repartition(max(1, math.ceil(counted["n"] / SHARD_ROWS)))
    index = stored(spread.mapInPandas(_index, SHARD), "impacts")
    blocks = max(1, math.ceil(counted["q"] / BLOCK_QUERIES))
    tasks = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Few queries still keep all tasks busy: a block meets the shards in slices.
    slices = max(1, min(math.ceil(tasks / blocks), math.ceil(counted["n"] / SHARD_ROWS)))
    queries = (
        rows.where(F.col("vec_id") % every == 0)
        .withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)))
        .withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))
        .select(
            "block", "slice", F.col("row").alias("q_row"), F.col("vec_id").alias("q_id"),
            F.col("x").alias("q"), F.lit(-1).cast("long").alias("shard"),
        )
    )
    zero = F.lit(0).cast("long")
    shards = (
        index.withColumn("block", F.explode(F.sequence(zero, F.lit(blocks - 1).cast("long"))))
        .withColumn("slice", F.pmod(F.xxhash64("shard"), F.lit(slices)).cast("int"))
        .withColumns({"q_row": zero, "q_id": zero})
    )
    met = (
        queries.unionByName(shards, allowMissingColumns=True)
        .repartition("block", "slice")
        .sortWithinPartitions("block", "slice", "shard")
    )
    found = met.mapInPandas(_search(k), FOUND)
    place = Window.partitionBy("query_row").orderBy(
        F.desc("score"), F.col("vec_id").asc_nulls_last(), "row"
    )
    return (
        found.withColumn("rank", F.row_number().over(place))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def oracle_sql(k: int = TOP, every: int = EVERY, scale: int = SCALE) -> str:
    """The same rows in DuckDB's SQL, every query against every row."""
    return f"""
    WITH quantised AS (
      SELECT vec_id, row_number() OVER () AS r,
             list_transform(embedding, lambda c: CAST(floor({scale} * c::DOUBLE) AS BIGINT)) AS x
      FROM embeddings
      WHERE embedding IS NOT NULL
        AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
    scored AS (
      SELECT q.r, q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(
               list_zip(q.x, c.x), lambda p: p[1] * p[2])) AS BIGINT) AS score, c.r AS c_r
      FROM quantised q JOIN quantised c ON q.r <> c.r WHERE q.vec_id % {every} = 0)
    SELECT query_id, CAST(row_number() OVER best AS INTEGER) AS rank, vec_id, score FROM scored
    WINDOW best AS (PARTITION BY r ORDER BY score DESC, vec_id ASC NULLS LAST, c_r)
    QUALIFY row_number() OVER best <= {k}
    """
