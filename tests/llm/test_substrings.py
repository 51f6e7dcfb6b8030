"""Removal of repeated spans against brute force."""

import hashlib
import random
import re

import edges
import pytest

from seatwise.llm import substrings


def words_of(text):
    return [w for w in re.split("[ \t-\r]+", text or "") if w]


def slow(rows, width):
    first = {}
    for doc, text in rows:
        words = words_of(text)
        for i in range(len(words) - width + 1):
            if doc is not None:
                run = tuple(words[i : i + width])
                first[run] = min(first.get(run, doc), doc)
    out = []
    for doc, text in rows:
        words = words_of(text)
        gone = set()
        for i in range(len(words) - width + 1):
            if doc is not None and first[tuple(words[i : i + width])] < doc:
                gone.update(range(i, i + width))
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((doc, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=lambda r: (r[0] is None, r))


def got(frame, width=13):
    rows = substrings.remove_repeats(frame, width).collect()
    return sorted((tuple(r) for r in rows), key=lambda r: (r[0] is None, r))


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("width", [3, 13])
def test_random_documents(spark, seed, width):
    rng = random.Random(seed)
    passages = [[f"w{rng.randrange(40)}" for _ in range(rng.randint(5, 60))] for _ in range(6)]
    rows = []
    for i in range(60):
        parts = []
        for _ in range(rng.randint(0, 5)):
            whole = rng.choice(passages)
            a = rng.randrange(len(whole))
            parts += whole[a:] if rng.random() < 0.5 else [f"x{rng.randrange(99)}"] * 8
        rows.append((rng.randrange(45), rng.choice(["  ", "\n", " "]).join(parts)))
    rows += rows[:5]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert got(frame, width) == slow(rows, width)


def test_awkward_rows(spark):
    rows = [(i, t) for i, t, *_ in edges.rows()]
    assert got(edges.documents(spark)) == slow(rows, 13)
    assert substrings.remove_repeats(edges.empty(spark)).count() == 0


def test_rows_that_share_an_id_but_not_a_text(spark):
    run = " ".join(f"r{i}" for i in range(20))
    rows = [(1, run), (2, f"a b {run}"), (2, f"quite other words {run} c"), (2, "short"), (3, run)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(frame) == slow(rows, 13)


def test_texts_in_pieces_give_the_same_words(monkeypatch):
    from seatwise.llm import common

    text = " ".join(f"word{i % 37}" * (i % 4) for i in range(5000)).encode()
    whole, counts = substrings._hasher().many([text, b"", b"a b"])
    monkeypatch.setattr(common, "CHUNK_BYTES", 64)
    pieces, again = substrings._hasher().many([text, b"", b"a b"])
    assert (whole == pieces).all() and (counts == again).all()
    assert counts.tolist() == [len(text.split()), 0, 2]


def test_a_path_that_differs_at_its_ends_is_found(spark):
    end = "struct<src_doc:long,src_start:long,length:long,words:binary>"
    rows = [([(1, 0, 5, b"x"), (1, 9, 5, b"y")], []), ([], [(1, 0, 5, b"x"), (1, 9, 5, b"z")])]
    cut = spark.createDataFrame(rows, f"targets array<{end}>, sources array<{end}>")
    assert [r["src_start"] for r in substrings.unequal_paths(cut).collect()] == [9]
