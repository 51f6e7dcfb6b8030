"""Fingerprints, links and components against brute force."""

import random
import re

import edges
import numpy as np
import pytest
import xxhash

from seatwise.llm import simhash


def slow_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in re.split("[ \t-\r]+", low) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(ids, fps):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in zip(ids, fps):
        for j, b in zip(ids, fps):
            if (a ^ b).bit_count() <= 4:
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_fingerprints():
    texts = [t for _, t, *_ in edges.rows()] + ["A b", "É É É É É", "x " * 7, " a b c d e"]
    assert [simhash.fingerprint(t) for t in texts] == [slow_fingerprint(t) for t in texts]


def test_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    fps = {i: slow_fingerprint(t) for i, t in texts.items()}
    expected = slow_components(list(fps), list(fps.values()))
    result = simhash.near_duplicates(docs).collect()
    assert len(result) == len(texts)
    for r in result:
        assert int(r["fingerprint"], 16) == fps[r["doc_id"]] and len(r["fingerprint"]) == 16
        assert r["component_id"] == expected[r["doc_id"]]


@pytest.mark.parametrize("most,equal", [(8192, None), (3, None), (8192, 3), (8192, 5)])
def test_links_connect_what_is_near(spark, monkeypatch, most, equal):
    monkeypatch.setattr(simhash, "CELL_ROWS", most)
    rng = random.Random(5)
    fps = []
    for _ in range(60):
        base = rng.getrandbits(64)
        for _ in range(rng.randint(1, 12)):
            fps.append(base)
            for _ in range(rng.randint(0, 5)):
                base ^= 1 << rng.randrange(64)
    fps = list(dict.fromkeys(fps))
    signed = [int(np.uint64(f).astype(np.int64)) for f in fps]
    frame = spark.createDataFrame([(f,) for f in signed], "fp long")
    links = [tuple(r) for r in simhash.fingerprint_links(frame, equal=equal).collect()]
    near = {f: i for i, f in enumerate(signed)}
    root = list(range(len(fps)))
    for _ in range(len(fps)):
        for a, b in links:
            assert (int(np.int64(a).astype(np.uint64)) ^ int(np.int64(b).astype(np.uint64))).bit_count() >= 1
            low = min(root[near[a]], root[near[b]])
            root[near[a]] = root[near[b]] = low
    slow = slow_components(list(range(len(fps))), fps)
    groups = {}
    for i, r in enumerate(root):
        groups.setdefault(r, set()).add(slow[i])
    assert all(len(g) == 1 for g in groups.values())
    assert len(groups) == len(set(slow.values()))


@pytest.mark.parametrize("equal", [2, 3, 6])
def test_the_distance_table_tells_pairs_apart(equal):
    rng = np.random.default_rng(equal)
    masks = simhash.blocks(4, equal)
    assert sum(m.bit_count() for m in masks) == 64 and sum(masks) == 2**64 - 1
    fps = rng.integers(0, 2**64, 4000, dtype=np.uint64)
    near = fps.copy()
    for _ in range(4):
        near ^= np.uint64(1) << rng.integers(0, 64, len(fps), dtype=np.uint64)
    table = simhash.pivot_distances(np.concatenate([fps, near]), masks)
    assert table.shape == (8000, 4 + equal, simhash.PIVOTS)
    i = np.arange(4000)
    # All pairs within the distance survive, next to none of the others does.
    assert len(simhash.survivors(table, i, i + 4000, 4)) == 4000
    assert len(simhash.survivors(table, i[1:], i[:-1], 4)) < 8
    same = (table[:4000] == table[4000:]).all(axis=2).sum(axis=1)
    assert same.min() >= equal


def test_pairs_go_by_the_distances_before_their_bits(monkeypatch):
    """Without the pivots' distances all pairs of a cell would be compared."""
    rng = np.random.default_rng(1)
    fps = rng.integers(0, 2**64, 300, dtype=np.uint64)
    fps[200:] = fps[:100] ^ np.uint64(5)
    table = simhash.pivot_distances(fps, simhash.blocks(4))
    compared = []
    kept = simhash.survivors

    def counted(*args):
        compared.append(len(kept(*args)))
        return kept(*args)

    monkeypatch.setattr(simhash, "survivors", counted)
    left, right = simhash.cell_links(fps, table, 4)
    assert sorted(zip(left.tolist(), right.tolist())) == [(i, i + 200) for i in range(100)]
    assert 100 <= sum(compared) < 110
    sizes = np.array([50] * 6)
    left, right = simhash.small_cell_links(fps, table, sizes, 4)
    assert len(left) == 0
    order = np.argsort(np.tile(np.arange(100), 3)[:300], kind="stable")
    left, right = simhash.small_cell_links(fps[order], table[order], np.array([3] * 100), 4)
    assert sorted(zip(left.tolist(), right.tolist())) == [(3 * i, 3 * i + 2) for i in range(100)]


def test_equal_blocks_grow_with_the_rows():
    found = [simhash.equal_blocks(n, 4) for n in (0, 1, 10**5, 10**7, 10**9, 10**11)]
    assert found == [2, 2, 2, 3, 4, 6]
    assert simhash.equal_blocks(10**12, 60) == 4
    assert len(simhash.blocks(0, 2)) == 2


def test_awkward_rows(spark):
    docs = edges.documents(spark)
    result = simhash.near_duplicates(docs).collect()
    assert len(result) == len(edges.rows())
    by_id = {r["doc_id"]: r for r in result}
    assert by_id[2]["component_id"] == by_id[1]["component_id"] == 1
    assert {by_id[i]["fingerprint"] for i in (3, 4, 5)} == {"0" * 16}
    assert {by_id[i]["component_id"] for i in (3, 4, 5)} == {3}
    assert simhash.near_duplicates(edges.empty(spark)).count() == 0
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    ids = sorted(r["doc_id"] or -1 for r in kept.select("doc_id").collect())
    assert ids == [-1, 1, 3, 6, 7, 8]


def test_one_row_of_each_group_stays_whatever_ids_rows_share(spark):
    words = lambda k: " ".join(f"w{k}x{i}" for i in range(40))
    rows = [
        (1, words(1), "a"), (1, words(2), "b"), (1, words(2), "b"), (2, words(1), "c"),
        (None, words(3), "d"), (None, words(3), "d"), (None, words(4), "e"), (3, words(4), "f"),
        (4, words(5), "h"), (4, words(5), "g"), (5, None, "i"), (6, "", "j"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = simhash.keep_first(docs)
    got = [(r["doc_id"], r["source"]) for r in kept.collect()]
    assert sorted(got, key=str) == sorted(
        [(1, "a"), (1, "b"), (None, "d"), (3, "f"), (5, "i"),
         next(x for x in got if x[0] == 4)], key=str
    )
    again = [tuple(r) for r in simhash.keep_first(docs.repartition(5)).collect()]
    assert sorted(again, key=str) == sorted((tuple(r) for r in kept.collect()), key=str)
