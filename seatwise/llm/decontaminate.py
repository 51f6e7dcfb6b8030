"""Benchmark decontamination by latent semantic retrieval.

Passages of all documents are TF-IDF vectors over hashed words. A randomised SVD
finds directions that keep their cosines: one pass counts documents by word, one
pass multiplies the matrix of all passages with a thin random one, each task
adding up its own share, and the rest is a small decomposition. In the last pass
every passage is projected, compared by cosine with the passages of all
benchmark items, and for the candidates the words decide: the longest common
subsequence with the item, and for a loose match the item's answer as well.

A projection only keeps cosines about right, and few words are lost among the
many of a passage. So passages of an item's own length are candidates as well
if they have as many of the item's rarer words as any match must have. The
count is exact: no match in such a passage is missed, however many items there are.

Only the model travels, whose size is a parameter, and the benchmark, a block of
items at a time. Documents are read where they lie and never shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seatwise.llm.common import WordHasher, chunks, stored, window_hashes

#: Places of a passage vector, as a power of two.
BITS = 14
#: Columns of the random matrix, and so directions at most.
RANK = 96
#: A passage is two blocks of words; the next one starts a block later.
BLOCK_WORDS = 24
#: Words in more than this share of the documents have no weight,
COMMON = 0.01
#: but so many of an item's words, the rarest ones, always have: an item that
#: leaked into a third of the documents has no rare words left.
TELLING_WORDS = 8
#: Cosine of a candidate, and the shares of an item's words in order that make a match.
COSINE = 0.35
MATCH = 0.6
LOOSE_MATCH = 0.45
#: Items from this many words on are also looked for by their words alone, in passages
#: of their own length. In fewer words an order says nothing: those are looked for as
#: runs, word for word, beside what the cosine finds.
ORDERED_WORDS = 6
#: Without an answer column, the last words of an item are taken as its answer.
ANSWER_WORDS = 6
ITEMS_PER_BLOCK = 2000
SLABS = 64
BATCH_BYTES = 1 << 19
#: Share of the words a match must have that are asked for among an item's rarest, and
#: cells counted at a time. Both change the work only, never a result.
RARE_SHARE = 0.2
COUNTED = 1 << 22
SEED = 5


@dataclass
class Item:
    item_id: int
    words: list[int]
    answer: list[int]


def _hasher() -> WordHasher:
    is_word = np.zeros(256, dtype=bool)
    is_word[ord("0") : ord("9") + 1] = is_word[ord("a") : ord("z") + 1] = True
    is_word[128:] = True
    return WordHasher(is_word)


def _encoded(texts) -> list[bytes]:
    return [(t or "").lower().encode("utf-8", "surrogatepass") for t in texts]


def _columns(words: np.ndarray) -> np.ndarray:
    return (words >> np.uint64(64 - BITS)).astype(np.uint16)


def _batches(texts: list[bytes], hasher: WordHasher) -> Iterator[tuple]:
    """(first document, words, words of each document) for pieces of a batch."""
    for a, b in chunks((len(t) + 64 for t in texts), BATCH_BYTES):
        words, counts = hasher.many(texts[a:b])
        if len(words):
            yield a, words, counts


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Documents by hashed word, and the number of documents at place -1."""
    hasher = _hasher()
    seen, documents = np.zeros(1 << BITS, dtype=np.int64), 0
    for batch in batches:
        documents += len(batch)
        for _, words, counts in _batches(_encoded(batch["text"]), hasher):
            # A batch has few enough documents for a pair to be a small number.
            pairs = np.repeat(np.arange(len(counts), dtype=np.int32) << BITS, counts)
            pairs |= _columns(words).astype(np.int32)
            pairs.sort()
            once = pairs[np.diff(pairs, prepend=-1) != 0] & ((1 << BITS) - 1)
            seen += np.bincount(once, minlength=1 << BITS)
    place = np.flatnonzero(seen)
    yield pd.DataFrame(
        {"place": np.append(place, -1), "documents": np.append(seen[place], documents)}
    )


def word_weights(
    docs: DataFrame, benchmark: DataFrame
) -> tuple[np.ndarray, np.ndarray] | None:
    """Inverse document frequency of each hashed word over all documents, and its documents.

    The items are gone through a block at a time for the words that have to keep
    a weight; a benchmark without any words gives none.
    """
    counted = docs.select("text").mapInPandas(_count, "place long, documents long")
    rows = counted.groupBy("place").agg(F.sum("documents").alias("n")).collect()
    known = {r["place"]: r["n"] for r in rows}
    total = max(1, known.pop(-1, 0))
    n = np.zeros(1 << BITS)
    n[list(known)] = list(known.values())
    kept, found = n <= max(COMMON * total, 10), False
    for items in _items(benchmark):
        found = True
        for item in items:
            mine = np.unique(_columns(np.array(item.words, dtype=np.uint64)))
            kept[mine[np.argsort(n[mine], kind="stable")[:TELLING_WORDS]]] = True
    weights = np.log((1 + total) / (1 + n)) + 1
    return ((weights * kept).astype(np.float32), n) if found else None


class Passages:
    """Sums of word vectors over the passages of several documents."""

    def __init__(self, columns: np.ndarray, counts: np.ndarray, weights: np.ndarray):
        ends = np.cumsum(counts)
        self.first = ends - counts
        blocks = -(-counts // BLOCK_WORDS)
        self.block_ends = np.cumsum(blocks)
        start = np.repeat(self.first, counts)
        in_doc = np.arange(len(columns)) - start
        offset = np.repeat(self.block_ends - blocks, counts)
        self.blocks = int(self.block_ends[-1]) if len(blocks) else 0
        tells = weights[columns] > 0
        self.columns = columns[tells]
        self.block = (offset + in_doc // BLOCK_WORDS)[tells]
        self.owner = np.repeat(np.arange(len(counts)), blocks)
        self.place = np.arange(self.blocks) - np.repeat(self.block_ends - blocks, blocks)
        #: Whether the block is followed by another of the same document.
        self.more = np.zeros(self.blocks, dtype=bool)
        self.more[:-1] = self.owner[1:] == self.owner[:-1]

    def per_block(self, values: np.ndarray) -> np.ndarray:
        """Sums over the words of each block of rows given for each word."""
        out = np.zeros((self.blocks, *values.shape[1:]), dtype=values.dtype)
        if len(values):
            starts = np.flatnonzero(np.diff(self.block, prepend=-1))
            out[self.block[starts]] = np.add.reduceat(values, starts, axis=0)
        return out

    def pairs(self, blocks: np.ndarray) -> np.ndarray:
        """Each block with the one that follows it."""
        out = blocks.copy()
        follows = np.flatnonzero(self.more)
        out[follows] += blocks[follows + 1]
        return out

    def back(self, passages: np.ndarray) -> np.ndarray:
        """For each block the sum of the passages it is part of."""
        out = passages.copy()
        follows = np.flatnonzero(self.more)
        out[follows + 1] += passages[follows]
        return out


def _sketch(weights: np.ndarray, rank: int):
    """A task's share of the transposed passage matrix times random signs."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher = _hasher()
        total = np.zeros((1 << BITS, rank), dtype=np.float32)
        for batch in batches:
            for _, words, counts in _batches(_encoded(batch["text"]), hasher):
                seen = Passages(_columns(words), counts, weights)
                if not len(seen.columns):
                    continue
                size = np.sqrt(seen.pairs(seen.per_block(weights[seen.columns] ** 2)))
                # The signs follow from the words, so a repeated task draws them alike.
                draw = np.random.default_rng([SEED, int(words.sum())])
                signs = draw.integers(0, 2, (seen.blocks, rank), dtype=np.int8) * 2 - 1
                share = seen.back(signs / np.maximum(size, 1e-6)[:, None].astype(np.float32))
                order = np.argsort(seen.columns, kind="stable")
                column = seen.columns[order]
                starts = np.flatnonzero(np.diff(column.astype(np.int32), prepend=-1))
                total[column[starts]] += np.add.reduceat(share[seen.block[order]], starts, axis=0)
        total *= weights[:, None]
        for slab, part in enumerate(np.split(total, SLABS)):
            if part.any():
                yield pd.DataFrame({"slab": [slab], "part": [part.tobytes()]})

    return run


def _add_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for slab, part in zip(batch["slab"], batch["part"]):
            values = np.frombuffer(part, dtype=np.float32).astype(np.float64)
            sums[slab] = sums[slab] + values if slab in sums else values
    for slab, values in sums.items():
        yield pd.DataFrame({"slab": [slab], "part": [values.astype(np.float32).tobytes()]})


def directions(docs: DataFrame, weights: np.ndarray, rank: int = RANK) -> np.ndarray:
    """Word vectors that project passages on the directions of a randomised SVD.

    With random signs ``W``, ``A'W`` has on average the Gram matrix of the
    passages ``A``, so its left singular vectors stand in for those of ``A'``.
    """
    parts = docs.select("text").mapInPandas(_sketch(weights, rank), "slab int, part binary")
    rows = parts.repartition(SLABS, "slab").mapInPandas(_add_up, "slab int, part binary").collect()
    y = np.zeros((SLABS, (1 << BITS) // SLABS, rank))
    for r in rows:
        y[r["slab"]] = np.frombuffer(r["part"], dtype=np.float32).reshape(-1, rank)
    left, values, _ = np.linalg.svd(y.reshape(1 << BITS, rank), full_matrices=False)
    left = left[:, values > max(values[0] * 1e-6, 1e-12)]
    return (weights[:, None] * left).astype(np.float32)


def subsequence(masks: dict[int, int], size: int, words: list[int]) -> int:
    """Length of the longest common subsequence; a bit for each of an item's words."""
    row = full = (1 << size) - 1
    for word in words:
        hit = row & masks.get(word, 0)
        if hit:
            row = ((row + hit) | (row - hit)) & full
    return size - row.bit_count()


def _stands_in(answer: list[int], words: list[int]) -> bool:
    """Whether the answer stands word for word among the words."""
    n = len(answer)
    starts = (i for i, w in enumerate(words) if w == answer[0])
    return any(words[i : i + n] == answer for i in starts)


def _masks(words: list[int]) -> dict[int, int]:
    out: dict[int, int] = {}
    for i, word in enumerate(words):
        out[word] = out.get(word, 0) | 1 << i
    return out


class Vocabulary:
    """Numbers for the words of some items, in the order of their hashes."""

    def __init__(self, items: list[Item]):
        self.words = np.unique(
            np.concatenate([np.array(i.words + i.answer, dtype=np.uint64) for i in items])
        )
        self.places = np.zeros(1 << BITS, dtype=bool)
        self.places[_columns(self.words)] = True

    def known(self, words: np.ndarray, columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where a word of the items stands, and its number."""
        at = np.flatnonzero(self.places[columns])
        found = words[at]
        number = np.minimum(np.searchsorted(self.words, found), len(self.words) - 1)
        same = self.words[number] == found
        return at[same], number[same]


class RareWords:
    """Words of the items that have about one length, to be counted in passages.

    A full match has ``need`` of an item's words at least. Without its ``size - need +
    least`` rarest words an item has too few left, so ``least`` of these stand in
    every full match, whatever the frequencies, and in a loose one the answer's
    rarest word does, which counts for as many. What has them is counted in full.
    """

    def __init__(
        self, block_words: int, numbers: list[int], items: list[Item], known: Vocabulary,
        documents: np.ndarray,
    ):
        self.block_words, self.numbers = block_words, np.array(numbers)
        self.vocabulary = len(known.words)
        seen = documents[_columns(known.words)]
        least, needs, rare, owners = [], [], [], []
        words, times, answers = [], [], []
        for i, number in enumerate(numbers):
            mine, answer = (
                np.searchsorted(known.words, np.array(w, dtype=np.uint64))
                for w in (items[number].words, items[number].answer)
            )
            need = math.ceil(MATCH * len(mine) - 1e-9)
            least.append(max(1, round(RARE_SHARE * need)))
            needs.append((need, math.ceil(LOOSE_MATCH * len(mine) - 1e-9)))
            for values, into in zip(np.unique(mine, return_counts=True), (words, times)):
                into.append(values)
            answers.append(np.unique(answer))
            order = np.argsort(seen[mine], kind="stable")
            rare.append(mine[order[: len(mine) - need + least[-1]]])
            rare.append(np.full(least[-1], answer[seen[answer].argmin()]))
            owners.append(np.full(len(rare[-2]) + len(rare[-1]), i))
        self.least = np.array(least, dtype=np.int32)
        self.need, self.loose_need = np.array(needs).T
        #: All words of an item, each once with its times, and of its answer.
        self.words, self.times = Lists(words), np.concatenate(times)
        self.answers = Lists(answers)
        #: The items that have a word among their rarest.
        rare = np.concatenate(rare)
        self.owners = np.concatenate(owners)[np.argsort(rare, kind="stable")]
        self.posts = np.bincount(rare, minlength=self.vocabulary)
        self.start = np.cumsum(self.posts) - self.posts

    def passages(self, at: np.ndarray, doc: np.ndarray, known: np.ndarray, counts: np.ndarray):
        """(document, its word the passage begins with, item) of every candidate."""
        blocks = -(-counts // self.block_words)
        ends = np.cumsum(counts)
        first = np.cumsum(blocks) - blocks
        owner = np.repeat(np.arange(len(counts)), blocks)
        block = first[doc] + (at - (ends - counts)[doc]) // self.block_words
        step = max(1, COUNTED // max(len(self.numbers), self.vocabulary))
        for low in range(0, len(owner), step):
            # One block more, for the second half of the last passage.
            high = min(len(owner), low + step + 1)
            more = np.append(owner[low + 1 : high] == owner[low : high - 1], False)
            a, b = np.searchsorted(block, [low, high])
            rows, found = self._candidates(block[a:b] - low, known[a:b], more)
            rows, found = rows[rows < step], found[rows < step]
            mine = owner[low + rows]
            begin = (low + rows - first[mine]) * self.block_words
            yield from zip(mine.tolist(), begin.tolist(), self.numbers[found].tolist())

    def _candidates(self, block: np.ndarray, known: np.ndarray, more: np.ndarray):
        """Blocks that with the next one, if there is more, have enough of an item's words."""
        width = len(self.numbers)
        telling = self.posts[known] > 0
        rare, times = known[telling], self.posts[known[telling]]
        hits = _ranges(self.start[rare], times)
        cell = np.repeat(block[telling] * width, times) + self.owners[hits]
        held = np.bincount(cell, minlength=len(more) * width).reshape(-1, width).astype(np.int32)
        pairs = held.copy()
        pairs[:-1][more[:-1]] += held[1:][more[:-1]]
        rows, found = np.nonzero(pairs >= self.least)
        if not len(rows):
            return rows, found
        stands = np.zeros((len(more) + 1, self.vocabulary), dtype=bool)
        stands[block, known] = True
        mine, row, starts = self.words.of(found, rows)
        word = self.words.values[mine]
        has = stands[row, word] | (stands[row + 1, word] & more[row])
        there = np.add.reduceat(has * self.times[mine], starts)
        loose = np.flatnonzero((there >= self.loose_need[found]) & (there < self.need[found]))
        enough = there >= self.need[found]
        if len(loose):
            mine, row, starts = self.answers.of(found[loose], rows[loose])
            word = self.answers.values[mine]
            has = stands[row, word] | (stands[row + 1, word] & more[row])
            enough[loose] = np.logical_and.reduceat(has, starts)
        return rows[enough], found[enough]


class Lists:
    """Lists one after the other, none of them empty."""

    def __init__(self, lists: list[np.ndarray]):
        self.values, self.sizes = np.concatenate(lists), np.array([len(x) for x in lists])
        self.first = np.cumsum(self.sizes) - self.sizes

    def of(self, numbers: np.ndarray, rows: np.ndarray) -> tuple:
        """Places of the lists' values, the row given for each, and where each list starts."""
        sizes = self.sizes[numbers]
        places = _ranges(self.first[numbers], sizes)
        return places, np.repeat(rows, sizes), np.cumsum(sizes) - sizes


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers of consecutive ranges."""
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))


def _rare_words(items: list[Item], known: Vocabulary, documents: np.ndarray) -> list[RareWords]:
    """The items by the length of their blocks, which hold a whole item each."""
    by_size: dict[int, list[int]] = {}
    for number, item in enumerate(items):
        if len(item.words) >= ORDERED_WORDS:
            size = ORDERED_WORDS
            while size < len(item.words):
                size *= 2
            by_size.setdefault(size, []).append(number)
    return [RareWords(size, mine, items, known, documents) for size, mine in sorted(by_size.items())]


class Retriever:
    """Items of one block, ready to be looked for in texts."""

    def __init__(
        self, items: list[Item], vectors: np.ndarray, weights: np.ndarray, documents: np.ndarray
    ):
        self.vocabulary = Vocabulary(items)
        self.rare = _rare_words(items, self.vocabulary, documents)
        self.items, self.vectors, self.weights = items, vectors, weights
        numbers = [
            np.searchsorted(self.vocabulary.words, np.array(i.words, dtype=np.uint64)) for i in items
        ]
        self.masks = [_masks(n.tolist()) for n in numbers]
        self.sizes = np.array([len(n) for n in numbers])
        each = [np.unique(n, return_counts=True) for n in numbers]
        #: An item's words, each once, and how often it has them.
        self.once, self.times = Lists([w for w, _ in each]), np.concatenate([t for _, t in each])
        self.longest = int(self.sizes.max())
        self.short = _short_items(items)
        columns = [_columns(np.array(i.words, dtype=np.uint64)) for i in items]
        counts = np.array([len(c) for c in columns], dtype=np.int64)
        seen = Passages(np.concatenate(columns), counts, weights)
        self.queries = _scaled(seen.pairs(seen.per_block(vectors[seen.columns])))
        # The rest after an item's last full pair of blocks says little by itself.
        whole = (seen.place == 0) | seen.more
        self.queries, self.owner = self.queries[whole], seen.owner[whole]
        self.hasher = _hasher()

    def find(self, texts: list[str | None]) -> Iterator[tuple[int, int, float, float, int, int]]:
        """(text, item, cosine, share of the item in order, first word, last word)."""
        for at, words, counts in _batches(_encoded(texts), self.hasher):
            columns = _columns(words)
            seen = Passages(columns, counts, self.weights)
            made = _scaled(seen.pairs(seen.per_block(self.vectors[seen.columns])))
            stand, known = self.vocabulary.known(words, columns)
            for low in range(0, len(made), 4096):
                cosine = made[low : low + 4096] @ self.queries.T
                rows, queries = np.nonzero(cosine >= COSINE)
                yield from self._checked(
                    at, words, counts, seen, stand, known, rows + low, queries, cosine[rows, queries]
                )
            owner = np.repeat(np.arange(len(counts)), counts)
            for doc, start, number in self._runs(words, owner):
                best = self._best_cosine(seen, made, doc, start, start + 1, number)
                last = start + int(self.sizes[number]) - 1
                yield at + doc, number, best, 1.0, start, last
            docs = owner[stand]
            for rare in self.rare:
                for doc, start, number in rare.passages(stand, docs, known, counts):
                    match = self._in_order(words, counts, seen, made, rare, doc, start, number)
                    if match:
                        yield at + doc, number, *match

    def _runs(self, words: np.ndarray, owner: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(document, first word, item) of each item of few words that stands word for word."""
        for width, (runs, numbers) in self.short.items():
            if len(words) < width:
                continue
            hashes = window_hashes(words, width)
            place = np.minimum(np.searchsorted(runs, hashes), len(runs) - 1)
            same = (runs[place] == hashes) & (owner[: len(hashes)] == owner[width - 1 :])
            for at in np.flatnonzero(same).tolist():
                doc = int(owner[at])
                first = int(np.searchsorted(owner, doc))
                k = int(np.searchsorted(runs, hashes[at]))
                while k < len(runs) and runs[k] == hashes[at]:
                    yield doc, at - first, numbers[k]
                    k += 1

    def _best_cosine(self, seen, made, doc, start, end, number) -> float:
        """The best of the passages around that all items are compared with."""
        first = int(np.searchsorted(seen.owner, doc))
        low, high = max(0, start // BLOCK_WORDS - 1), (end - 1) // BLOCK_WORDS + 1
        near = made[first + low : first + high] @ self.queries[self.owner == number].T
        return float(near.max())

    def _in_order(self, words, counts, seen, made, rare, doc, start, number):
        """The match of an item with a passage of its own length, if it is one."""
        item, begin = self.items[number], int(seen.first[doc])
        end = min(int(counts[doc]), start + 2 * rare.block_words)
        near = words[begin + start : begin + end]
        numbers = np.minimum(np.searchsorted(self.vocabulary.words, near), rare.vocabulary - 1)
        numbers[self.vocabulary.words[numbers] != near] = -1
        share = subsequence(self.masks[number], len(item.words), numbers.tolist()) / len(item.words)
        if share < MATCH and (share < LOOSE_MATCH or not _stands_in(item.answer, near.tolist())):
            return None
        return self._best_cosine(seen, made, doc, start, end, number), share, start, end - 1

    def _checked(self, at, words, counts, seen, stand, known, rows, queries, cosines):
        """Matches among pairs of a passage and an item of like direction.

        Only words of the items can be in a common subsequence, ``known`` at the
        places ``stand``, and no more of an item's words than stand in the passage.
        """
        if not len(rows):
            return
        number, doc = self.owner[queries], seen.owner[rows]
        begin, end = seen.first[doc], seen.first[doc] + counts[doc]
        start = begin + seen.place[rows] * BLOCK_WORDS
        size = self.sizes[number]
        low = np.maximum(begin, start - size)
        high = np.minimum(end, start + 2 * BLOCK_WORDS + size)
        enough = self._enough(stand, known, rows, begin, start, end, number)
        first, last = np.searchsorted(stand, low), np.searchsorted(stand, high)
        for i in np.flatnonzero(enough).tolist():
            n = int(number[i])
            near = known[first[i] : last[i]].tolist()
            share = subsequence(self.masks[n], int(size[i]), near) / int(size[i])
            if share >= MATCH or share >= LOOSE_MATCH and _stands_in(
                self.items[n].answer, words[low[i] : high[i]].tolist()
            ):
                where = int(begin[i])
                yield (
                    at + int(doc[i]), n, float(cosines[i]), share,
                    int(low[i]) - where, int(high[i]) - where - 1,
                )

    def _enough(self, stand, known, rows, begin, start, end, number) -> np.ndarray:
        """Whether so many of an item's words stand around a passage as a match needs."""
        own, index, place = np.unique(rows, return_index=True, return_inverse=True)
        low = np.maximum(begin, start - self.longest)[index]
        high = np.minimum(end, start + 2 * BLOCK_WORDS + self.longest)[index]
        first, last = np.searchsorted(stand, low), np.searchsorted(stand, high)
        width = len(self.vocabulary.words)
        out = np.zeros(len(rows), dtype=bool)
        step = max(1, COUNTED // width)
        order = np.argsort(place, kind="stable")
        edges = np.searchsorted(place[order], np.arange(0, len(own) + step, step))
        for k, a in enumerate(range(0, len(own), step)):
            here = slice(a, min(a + step, len(own)))
            sizes = last[here] - first[here]
            stands = np.zeros((len(sizes), width), dtype=bool)
            stands[np.repeat(np.arange(len(sizes)), sizes), known[_ranges(first[here], sizes)]] = True
            mine = order[edges[k] : edges[k + 1]]
            for b in range(0, len(mine), 1 << 16):
                some = mine[b : b + (1 << 16)]
                values, row, starts = self.once.of(number[some], place[some] - a)
                held = stands[row, self.once.values[values]] * self.times[values]
                there = np.add.reduceat(held, starts)
                out[some] = there >= LOOSE_MATCH * self.sizes[number[some]]
        return out


def _short_items(items: list[Item]) -> dict[int, tuple[np.ndarray, list[int]]]:
    """Items of fewer words than an order needs, by length: their runs' hashes, sorted."""
    by_width: dict[int, list[tuple[int, int]]] = {}
    for number, item in enumerate(items):
        width = len(item.words)
        if width < ORDERED_WORDS:
            run = window_hashes(np.array(item.words, dtype=np.uint64), width)
            by_width.setdefault(width, []).append((int(run[0]), number))
    return {
        width: (np.array([h for h, _ in sorted(runs)], dtype=np.uint64), [n for _, n in sorted(runs)])
        for width, runs in by_width.items()
    }


def _scaled(vectors: np.ndarray) -> np.ndarray:
    size = np.linalg.norm(vectors, axis=1, keepdims=True)
    return vectors / np.maximum(size, 1e-12)


def _items(benchmark: DataFrame) -> Iterator[list[Item]]:
    """Items with words, a bounded block at a time."""
    answer = F.col("answer").cast("string") if "answer" in benchmark.columns else F.lit(None)
    rows = benchmark.where(F.col("item_id").isNotNull() & F.col("text").isNotNull()).select(
        F.col("item_id").cast("long").alias("item_id"),
        F.col("text").cast("string").alias("text"),
        answer.cast("string").alias("answer"),
    )
    blocks = -(-rows.count() // ITEMS_PER_BLOCK)
    hasher = _hasher()
    for block in range(blocks):
        mine = rows.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block)
        items = []
        for r in mine.orderBy("item_id", "text").collect():
            words = hasher.many(_encoded([r["text"]]))[0].tolist()
            last = hasher.many(_encoded([r["answer"]]))[0].tolist()
            if words:
                items.append(Item(r["item_id"], words, last or words[-ANSWER_WORDS:]))
        if items:
            yield items


def retrievers(docs: DataFrame, benchmark: DataFrame) -> Iterator[Retriever]:
    """One for each block of items; only one block is on the driver at a time."""
    counted = word_weights(docs, benchmark)
    if counted is None:
        return
    weights, documents = counted
    vectors = directions(docs, weights)
    for items in _items(benchmark):
        yield Retriever(items, vectors, weights, documents)


def _matches(retriever: Retriever):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["row", "item_id", "cosine", "overlap", "first_word", "last_word"]
        for batch in batches:
            rows = [
                (doc, retriever.items[n].item_id, *rest)
                for doc, n, *rest in retriever.find(batch["text"].tolist())
            ]
            found = pd.DataFrame(rows, columns=names)
            found = found.sort_values(
                ["row", "item_id", "overlap", "cosine"], ascending=[True, True, False, False]
            ).drop_duplicates(["row", "item_id"])
            ids = batch["doc_id"].astype("Int64").to_numpy()
            found.insert(0, "doc_id", pd.array(ids[found["row"].to_numpy(dtype=int)], dtype="Int64"))
            yield found.drop(columns="row")

    return run


MATCH_SCHEMA = (
    "doc_id long, item_id long, cosine double, overlap double, first_word long, last_word long"
)


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Matches of benchmark items: ``doc_id, item_id, cosine, overlap, first_word,
    last_word``, one row for a document and an item, the best place.

    ``overlap`` is the share of the item's words that stand in the document in
    order, around the passage; words are counted from 0. Null and empty texts and
    items match nothing, no documents or an empty benchmark give no rows, repeated
    rows each have their matches, also such without an id. Texts are read whole
    whatever their length. Other columns are left aside whatever their names.
    """
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    out, written = None, []
    for retriever in retrievers(texts, benchmark):
        # With a further block, the one before is written, once, and its items are let go.
        if out is not None:
            written.append(stored(out, "leaks"))
        out = texts.mapInPandas(_matches(retriever), MATCH_SCHEMA)
    if out is None:
        return docs.sparkSession.createDataFrame([], MATCH_SCHEMA)
    return reduce(DataFrame.union, [*written, out])


def _is_clean(retriever: Retriever):
    @F.pandas_udf("boolean")
    def clean(text: pd.Series) -> pd.Series:
        out = np.ones(len(text), dtype=bool)
        for found in retriever.find(text.tolist()):
            out[found[0]] = False
        return pd.Series(out)

    return clean


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows that hold no benchmark item, all columns as they are.

    Null and empty texts hold none, very long ones are read whole, repeated rows stay
    or go together. No documents give no rows; an empty benchmark leaves all.
    """
    out = docs
    texts = docs.select(F.col("text").cast("string").alias("text"))
    for number, retriever in enumerate(retrievers(texts, benchmark)):
        out = stored(out, "clean") if number else out
        out = out.where(_is_clean(retriever)(F.col("text").cast("string")))
    return out
