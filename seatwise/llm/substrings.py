"""Long repeated spans of words, by compaction of a de Bruijn graph.

Every run of ``width`` words is an edge of the graph. Most edges occur once and
are never moved: each window has an anchor, the smallest hash among its shorter
runs, equal windows have equal anchors, and only windows whose anchor occurs in
two documents are looked at further. Windows in a row under one anchor travel
together. Those that stand in an earlier document too are compacted, first under
their anchor and then along the document, into paths: as long as both source and
copy go on word by word, nothing branches and the path grows. At last each path
is read at its source and at its copy, and the words must be the same.

A task packs the hashes it sends to a bucket into one row, so a repeated window
costs a few bytes and a document that holds it a thousand times counts once. What
a batch of documents can settle by itself does not meet in a bucket at all: of a
window that many of them share only the first one's goes there, the others have
found their source. So a passage in a third of all documents fills no task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seatwise.llm.common import WordHasher, chunks, stored, window_hashes

WIDTH = 13
#: Words of an anchor.
ANCHOR_WORDS = 7
#: Bytes of text worked on at a time.
BATCH_BYTES = 4 << 20
#: Rows of what a batch has settled that travel together.
PIECE = 4096
#: Other hashes are tried this often if a path's words differ at its two ends.
ATTEMPTS = 4

#: A place is a word's number in these low bits, above them a hash of its text.
PLACE_BITS = 32

#: Fixed: white space between words; everything else is part of a word.
SPACES = b" \t\n\v\f\r"


def _hasher() -> WordHasher:
    is_word = np.ones(256, dtype=bool)
    is_word[list(SPACES)] = False
    return WordHasher(is_word)


def _origin(text: bytes) -> int:
    """Where a row's places begin: rows that share an id but not a text stay apart."""
    return (xxhash.xxh64_intdigest(text) >> 33) << PLACE_BITS


def _encoded(texts) -> list[bytes]:
    return [(t or "").encode("utf-8", "surrogatepass") for t in texts]


class Windows:
    """The windows of a batch of documents: places, owners, anchors."""

    def __init__(self, texts: list[bytes], hasher: WordHasher, width: int, seed: int):
        self.words, counts = hasher.many(texts)
        if seed:
            self.words = window_hashes(self.words, 1, seed)
        inner = min(ANCHOR_WORDS, width)
        spare = width - inner + 1
        self.owner = self.at = self.anchor_at = np.zeros(0, dtype=np.int64)
        self.anchor = np.zeros(0, dtype=np.uint64)
        if len(self.words) < width:
            return
        short = window_hashes(self.words, inner, 2 * seed + 1)
        lead = sliding_window_view(short, spare).argmin(axis=1)
        ends = np.cumsum(counts)
        owner = np.repeat(np.arange(len(texts)), counts)[: len(lead)]
        inside = np.flatnonzero(np.arange(len(lead)) + width <= ends[owner])
        self.at = inside
        self.owner = owner[inside]
        self.anchor_at = inside + lead[inside]
        self.anchor = short[self.anchor_at]
        self.first = ends - counts


def _pack(frame: list, bucket, settled, docs, counts, **arrays) -> None:
    frame.append(
        {
            "bucket": int(bucket),
            "settled": bool(settled),
            "docs": docs.astype(np.int64).tobytes(),
            "counts": counts.astype(np.int32).tobytes(),
            **{name: values.tobytes() for name, values in arrays.items()},
        }
    )


def _by_bucket(keys: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """Rows of each bucket, in their order."""
    number = ((keys >> np.uint64(20)) % np.uint64(buckets)).astype(np.int32)
    order = np.argsort(number, kind="stable")
    edges = np.flatnonzero(np.diff(number[order])) + 1
    for rows in np.split(order, edges):
        if len(rows):
            yield int(number[rows[0]]), rows


def _runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First place and length of each run of equal values."""
    fresh = np.ones(len(values), dtype=bool)
    fresh[1:] = values[1:] != values[:-1]
    starts = np.flatnonzero(fresh)
    return starts, np.diff(np.concatenate([starts, [len(values)]]))


def _anchors(width: int, buckets: int, seed: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher = _hasher()
        for batch in batches:
            batch = batch[batch["doc_id"].notna()]
            ids = batch["doc_id"].to_numpy(dtype=np.int64)
            texts = _encoded(batch["text"])
            for a, b in chunks(map(len, texts), BATCH_BYTES):
                seen = Windows(texts[a:b], hasher, width, seed)
                if not len(seen.at):
                    continue
                key = seen.anchor
                fresh = np.ones(len(key), dtype=bool)
                fresh[1:] = (key[1:] != key[:-1]) | (seen.owner[1:] != seen.owner[:-1])
                key, docs = key[fresh], ids[a:b][seen.owner[fresh]]
                out: list = []
                settled, sent = _settle_anchors(key, docs)
                # Those already known to be shared go wherever there is room.
                for i, rows in enumerate(np.split(settled, range(PIECE, len(settled), PIECE))):
                    if len(rows):
                        bucket = (int(key[rows[0]]) + i) % buckets
                        first, counts = _runs(docs[rows])
                        _pack(out, bucket, True, docs[rows][first], counts, anchors=key[rows])
                for bucket, rows in _by_bucket(key[sent], buckets):
                    rows = sent[rows]
                    first, counts = _runs(docs[rows])
                    _pack(out, bucket, False, docs[rows][first], counts, anchors=key[rows])
                yield pd.DataFrame(out)

    return run


def _settle_anchors(key: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows whose anchor several documents of the batch have, and rows to send on.

    Of such an anchor two documents are sent on, so that any other one that has
    it meets a document that is not itself; of the rest every row.
    """
    order = np.lexsort((docs, key))
    starts, counts = _runs(key[order])
    ends = starts + counts - 1
    several = docs[order[starts]] != docs[order[ends]]
    settled = np.sort(order[np.repeat(several, counts)])
    sent = np.concatenate([order[starts], order[ends[several]]])
    return settled, np.unique(sent)


def _joined(group: pd.DataFrame, name: str, kind) -> np.ndarray:
    return np.frombuffer(b"".join(group[name]), dtype=kind)


def _owners(group: pd.DataFrame) -> np.ndarray:
    return np.repeat(_joined(group, "docs", np.int64), _joined(group, "counts", np.int32))


def _repeated_anchors(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
    """Anchors of a bucket that stand in two documents, for each document once."""
    known, group = group[group["settled"]], group[~group["settled"]]
    docs, anchors = _owners(group), _joined(group, "anchors", np.uint64)
    order = np.lexsort((docs, anchors))
    docs, anchors = docs[order], anchors[order]
    starts, counts = _runs(anchors)
    several = np.repeat(docs[starts] != docs[starts + counts - 1], counts)
    docs = np.concatenate([docs[several], _owners(known)])
    anchors = np.concatenate([anchors[several], _joined(known, "anchors", np.uint64)])
    found = pd.DataFrame({"doc_id": docs, "anchor": anchors.view(np.int64)})
    return found.drop_duplicates()


def _edges(width: int, buckets: int, seed: int):
    """Windows under the anchors a document shares, packed by the anchor's bucket."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher = _hasher()
        for batch in batches:
            batch = batch[batch["shared"].notna()]
            ids = batch["doc_id"].to_numpy(dtype=np.int64)
            texts, shared = _encoded(batch["text"]), list(batch["shared"])
            for a, b in chunks(map(len, texts), BATCH_BYTES):
                seen = Windows(texts[a:b], hasher, width, seed)
                keep = np.zeros(len(seen.at), dtype=bool)
                bounds = np.searchsorted(seen.owner, np.arange(b - a + 1))
                for i in range(b - a):
                    own = slice(bounds[i], bounds[i + 1])
                    known = np.sort(np.asarray(shared[a + i], dtype=np.int64).view(np.uint64))
                    place = np.searchsorted(known, seen.anchor[own])
                    place[place == len(known)] = 0
                    keep[own] = known[place] == seen.anchor[own]
                if not keep.any():
                    continue
                edges = window_hashes(seen.words, width, 2 * seed + 2)[seen.at[keep]]
                owner, anchor = seen.owner[keep], seen.anchor[keep]
                origins = np.array([_origin(t) for t in texts[a:b]], dtype=np.int64)
                at = seen.at[keep] - seen.first[owner] + origins[owner]
                docs, out = ids[a:b][owner], []
                copies, first = _copies_of(anchor, edges, docs, at)
                for i in range(0, len(copies), PIECE):
                    part = copies.iloc[i : i + PIECE]
                    _pack(
                        out,
                        (int(part["src_doc"].iloc[0]) + i // PIECE) % buckets,
                        True,
                        part["doc_id"].to_numpy(),
                        np.ones(len(part)),
                        anchors=part["src_doc"].to_numpy(),
                        places=part["start"].to_numpy(),
                        sizes=part["length"].to_numpy().astype(np.int32),
                        edges=part["src_start"].to_numpy(),
                    )
                # Windows in a row under one anchor make one group.
                row = np.flatnonzero(first)
                apart = np.ones(len(row), dtype=bool)
                same = seen.anchor_at[keep][row]
                apart[1:] = (same[1:] != same[:-1]) | (np.diff(row) != 1)
                starts = np.flatnonzero(apart)
                counts = np.diff(np.append(starts, len(row)))
                for bucket, rows in _by_bucket(anchor[row[starts]], buckets):
                    heads, sizes = row[starts[rows]], counts[rows]
                    begins, docs_n = _runs(docs[heads])
                    _pack(
                        out,
                        bucket,
                        False,
                        docs[heads][begins],
                        docs_n,
                        anchors=anchor[heads],
                        places=at[heads],
                        sizes=sizes.astype(np.int32),
                        edges=edges[np.repeat(heads, sizes) + _ramp(sizes)],
                    )
                yield pd.DataFrame(out)

    return run


RUN = ["doc_id", "start", "length", "src_doc", "src_start"]


def _copies_of(anchors, edges, docs, places) -> tuple[pd.DataFrame, np.ndarray]:
    """Runs of windows that stand in a smaller document too, and the rest.

    Each window's source is its smallest document and the first place in it. The
    rest are the windows of those smallest documents, as a mask.
    """
    order = np.lexsort((places, docs, edges, anchors))
    fresh = np.ones(len(order), dtype=bool)
    sorted_edges, sorted_anchors = edges[order], anchors[order]
    fresh[1:] = (sorted_edges[1:] != sorted_edges[:-1]) | (
        sorted_anchors[1:] != sorted_anchors[:-1]
    )
    starts = np.flatnonzero(fresh)
    source = order[starts[np.cumsum(fresh) - 1]] if len(order) else order
    later = docs[order] > docs[source]
    first = np.ones(len(docs), dtype=bool)
    first[order[later]] = False
    rows, source = order[later], source[later]
    copy = pd.DataFrame(
        {
            "doc_id": docs[rows],
            "start": places[rows],
            "src_doc": docs[source],
            "src_start": places[source],
        }
    )
    copy = copy.drop_duplicates(["doc_id", "start"]).sort_values(["doc_id", "start"])
    step = copy.diff()
    goes_on = (
        (step["doc_id"] == 0)
        & (step["start"] == 1)
        & (step["src_doc"] == 0)
        & (step["src_start"] == 1)
    ).to_numpy()
    heads = np.flatnonzero(~goes_on)
    out = copy.iloc[heads].copy()
    out["length"] = np.diff(np.append(heads, len(copy)))
    return out[RUN], first


def _ramp(sizes: np.ndarray) -> np.ndarray:
    """0, 1, ... within each of several groups."""
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _copied(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
    """Runs of windows of a bucket that stand in a document with a smaller id."""
    known, group = group[group["settled"]], group[~group["settled"]]
    settled = pd.DataFrame(
        {
            "doc_id": _joined(known, "docs", np.int64),
            "start": _joined(known, "places", np.int64),
            "length": _joined(known, "sizes", np.int32).astype(np.int64),
            "src_doc": _joined(known, "anchors", np.int64),
            "src_start": _joined(known, "edges", np.int64),
        }
    )
    sizes = _joined(group, "sizes", np.int32).astype(np.int64)
    found, _ = _copies_of(
        np.repeat(_joined(group, "anchors", np.uint64), sizes),
        _joined(group, "edges", np.uint64),
        np.repeat(_owners(group), sizes),
        np.repeat(_joined(group, "places", np.int64), sizes) + _ramp(sizes),
    )
    return pd.concat([settled, found])


def _digest(words: list[bytes]) -> bytes:
    return hashlib.blake2b(b" ".join(words), digest_size=16).digest()


def _cut(width: int):
    """What is left of each document, and the words of its paths at both ends."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc_id, text, paths, asked in zip(
                batch["doc_id"].astype("Int64"), batch["text"], batch["paths"], batch["asked"]
            ):
                raw = (text or "").encode("utf-8", "surrogatepass")
                words, origin = raw.split(), _origin(raw)

                def span(first: int, length: int) -> tuple[int, int] | None:
                    low = first - origin
                    own = 0 <= low < 1 << PLACE_BITS
                    return (low, low + length + width - 1) if own else None

                def end(path: dict, low: int, high: int) -> dict:
                    names = ("src_doc", "src_start", "length")
                    return {n: int(path[n]) for n in names} | {"words": _digest(words[low:high])}

                gone, targets, sources = np.zeros(len(words) + 1, dtype=np.int64), [], []
                for path in () if paths is None else paths:
                    if own := span(path["start"], path["length"]):
                        gone[own[0]] += 1
                        gone[own[1]] -= 1
                        targets.append(end(path, *own))
                for path in () if asked is None else asked:
                    if own := span(path["src_start"], path["length"]):
                        sources.append(end(path, *own))
                covered = np.cumsum(gone)[:-1] > 0
                kept = [w for w, c in zip(words, covered.tolist()) if not c] if targets else words
                rows.append(
                    (
                        doc_id,
                        len(words),
                        int(covered.sum()),
                        hashlib.sha256(b" ".join(kept)).hexdigest(),
                        targets,
                        sources,
                    )
                )
            names = ["doc_id", "n_words", "n_removed", "kept_sha256", "targets", "sources"]
            out = pd.DataFrame(rows, columns=names)
            out["doc_id"] = out["doc_id"].astype("Int64")
            yield out

    return run


END = "array<struct<src_doc:long,src_start:long,length:long,words:binary>>"
CUT = (
    "doc_id long, n_words long, n_removed long, kept_sha256 string, "
    f"targets {END}, sources {END}"
)


def paths_of(copies: DataFrame) -> DataFrame:
    """Runs that continue each other in copy and source, compacted to paths.

    Rows alike in id and text may bring the same run, or one with another source.
    """
    copies = copies.repartition("doc_id").distinct()
    order = Window.partitionBy("doc_id").orderBy("start", "length", "src_doc", "src_start")
    after = F.lag(F.struct("start", "length", "src_doc", "src_start")).over(order)
    goes_on = (
        (after["start"] + after["length"] == F.col("start"))
        & (after["src_doc"] == F.col("src_doc"))
        & (after["src_start"] + after["length"] == F.col("src_start"))
    )
    fresh = F.when(goes_on, 0).otherwise(1)
    return (
        copies.withColumn("fresh", fresh)
        .withColumn("path", F.sum("fresh").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy("doc_id", "path")
        .agg(
            F.min("start").alias("start"),
            F.sum("length").alias("length"),
            F.min("src_doc").alias("src_doc"),
            F.min("src_start").alias("src_start"),
        )
        .drop("path")
    )


def _once(texts: DataFrame, width: int, seed: int) -> DataFrame:
    buckets = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    packed = "bucket int, settled boolean, docs binary, counts binary, anchors binary"
    shared = (
        texts.mapInPandas(_anchors(width, buckets, seed), packed)
        .groupBy("bucket")
        .applyInPandas(_repeated_anchors, "doc_id long, anchor long")
        .groupBy(F.col("doc_id").alias("id"))
        .agg(F.collect_list("anchor").alias("shared"))
    )
    # Both joins read the texts through one and the same exchange.
    looked_at = texts.join(shared, texts.doc_id == shared.id, "left").drop("id")
    copies = (
        looked_at.mapInPandas(
            _edges(width, buckets, seed),
            f"{packed}, places binary, sizes binary, edges binary",
        )
        .groupBy("bucket")
        .applyInPandas(
            _copied, "doc_id long, start long, length long, src_doc long, src_start long"
        )
    )
    paths = paths_of(copies)
    span = F.struct("src_doc", "src_start", "start", "length")
    role = F.lit(None).cast("struct<src_doc:long,src_start:long,start:long,length:long>")
    asked = paths.groupBy("src_doc", "src_start", "length").agg(F.lit(0).cast("long").alias("start"))
    wanted = (
        paths.select(F.col("doc_id").alias("id"), span.alias("path"), role.alias("ask"))
        .union(asked.select(F.col("src_doc").alias("id"), role.alias("path"), span.alias("ask")))
        .groupBy("id")
        .agg(F.collect_list("path").alias("paths"), F.collect_list("ask").alias("asked"))
    )
    cut = texts.join(wanted, texts.doc_id == wanted.id, "left").drop("id")
    return stored(cut.mapInPandas(_cut(width), CUT), "cut")


def unequal_paths(cut: DataFrame) -> DataFrame:
    """Paths whose words at the source are not those of the copy."""
    columns = ["src_doc", "src_start", "length", "words"]
    targets = cut.select(F.explode("targets").alias("e")).select("e.*").select(columns).distinct()
    sources = cut.select(F.explode("sources").alias("e")).select("e.*").select(columns).distinct()
    return targets.join(sources, columns, "left_anti")


def remove_repeats(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept_sha256)``, one row for each input row.

    A word goes if a window of ``width`` words covers it whose words also stand
    in a document with a smaller id, judged on the input. Null and empty texts
    have no words. Rows that share an id do not make each other repeats; a row
    with a null id neither loses words nor takes any. Texts are read whole whatever
    their length, no rows give none. Only ``doc_id`` and ``text`` are read, other
    columns are left aside whatever their names.
    """
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    for seed in range(ATTEMPTS):
        cut = _once(texts, width, seed)
        if unequal_paths(cut).isEmpty():
            return cut.select("doc_id", "n_words", "n_removed", "kept_sha256")
    raise RuntimeError("different words shared every hash tried")


def oracle_sql(width: int = WIDTH) -> str:
    """The same rows in DuckDB's SQL."""
    return f"""
    WITH texts AS (
      SELECT doc_id, list_filter(
               string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'),
               lambda w: w <> '') AS words
      FROM documents),
    windows AS (
      SELECT doc_id, start, array_to_string(words[start + 1 : start + {width}], ' ') AS run
      FROM (SELECT doc_id, words, unnest(range(len(words) - {width - 1})) AS start FROM texts)),
    copies AS (
      SELECT doc_id, start
      FROM windows JOIN (SELECT run, min(doc_id) AS first FROM windows GROUP BY run) USING (run)
      WHERE doc_id > first),
    gone AS (
      SELECT DISTINCT doc_id, start + step AS place
      FROM copies, (SELECT unnest(range({width})) AS step)),
    places AS (
      SELECT doc_id, unnest(words) AS word, unnest(range(len(words))) AS place FROM texts),
    kept AS (
      SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY place) AS rest
      FROM places ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id)
    SELECT t.doc_id, len(words)::BIGINT AS n_words,
           (len(words) - coalesce(k.n, 0))::BIGINT AS n_removed,
           sha256(coalesce(rest, '')) AS kept_sha256
    FROM texts t LEFT JOIN kept k USING (doc_id)
    """
