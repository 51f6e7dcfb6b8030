"""Leaked items against a search for their word runs."""

import collections
import random
import re

import edges
import pytest

from seatwise.llm import decontaminate


def words(text):
    return re.findall("[0-9a-z\u0080-\U0010ffff]+", (text or "").lower())


def leaks(docs, items):
    """Pairs that share half of an item's runs of five words."""
    runs, size = collections.defaultdict(set), {}
    for i, text in items:
        w = words(text)
        mine = {tuple(w[k : k + 5]) for k in range(len(w) - 4)}
        size[i] = len(mine)
        for run in mine:
            runs[run].add(i)
    out = set()
    for d, text in docs:
        w = words(text)
        seen = collections.Counter()
        for run in {tuple(w[k : k + 5]) for k in range(len(w) - 4)}:
            seen.update(runs.get(run, ()))
        out |= {(d, i) for i, n in seen.items() if n >= size[i] / 2}
    return out


def test_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    expected = leaks(
        [(r["doc_id"], r["text"]) for r in docs.collect()],
        [(r["item_id"], r["text"]) for r in items.collect()],
    )
    found = decontaminate.find_leaks(docs, items).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == expected
    assert len(found) == len(expected) > 10
    kept = decontaminate.keep_clean(docs, items)
    assert kept.columns == docs.columns
    gone = {d for d, _ in expected}
    assert {r["doc_id"] for r in kept.select("doc_id").collect()} == {
        r["doc_id"] for r in docs.collect()
    } - gone


def test_blocks_of_items_give_the_same_matches_each_written_once(spark, sf_dir, monkeypatch):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    pairs = lambda df: sorted((r["doc_id"], r["item_id"]) for r in df.collect())
    whole = pairs(decontaminate.find_leaks(docs, items))
    monkeypatch.setattr(decontaminate, "ITEMS_PER_BLOCK", max(1, items.count() // 4))
    written, kept = [], decontaminate.stored

    def counted(df, label):
        out = kept(df, label)
        if label == "leaks":
            written.append(out.count())
        return out

    monkeypatch.setattr(decontaminate, "stored", counted)
    assert pairs(decontaminate.find_leaks(docs, items)) == whole
    # No block writes the matches of those before it again.
    assert len(written) > 1 and sum(written) <= len(whole)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(2)
    vocabulary = [f"{a}{b}{c}" for a in "bdfgk" for b in "aeiou" for c in "lmnrstvz"] * 3
    vocabulary += ["the", "of", "and"] * 40
    some = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    docs = [some(rng.randint(20, 200)) for _ in range(150)]
    items = [some(rng.randint(18, 50)) for _ in range(12)]
    return rng, docs, items


def frames(spark, docs, items):
    return (
        spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string"),
        spark.createDataFrame(list(enumerate(items)), "item_id long, text string"),
    )


def test_exact_disguised_and_reworded_leaks(spark, corpus):
    rng, docs, items = corpus
    docs = [list(d) for d in docs]
    expected = set()
    for n, item in enumerate(items):
        kind = n % 3
        put = list(item)
        if kind == 1:
            put = [f"{w.upper()}!!" for w in put]
        if kind == 2:
            for at in rng.sample(range(len(put) - 6), len(put) // 6):
                put[at] = f"new{at}"
        at = rng.randrange(len(docs[n * 5]))
        docs[n * 5][at:at] = put
        expected.add((n * 5, n))
    docs, items = ([" ".join(t) for t in texts] for texts in (docs, items))
    found = decontaminate.find_leaks(*frames(spark, docs, items)).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == expected


def test_an_item_in_a_third_of_all_documents(spark, corpus):
    _, docs, items = corpus
    texts = [" ".join(d + items[0] if i % 3 == 0 else d) for i, d in enumerate(docs)]
    found = decontaminate.find_leaks(*frames(spark, texts, [" ".join(i) for i in items])).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == {(i, 0) for i in range(0, 150, 3)}


def test_blocks_of_items_find_the_same(spark, corpus, monkeypatch):
    _, docs, items = corpus
    texts = [" ".join(d + items[i % 12]) for i, d in enumerate(docs)]
    data = frames(spark, texts, [" ".join(i) for i in items])
    pairs = lambda: {
        (r["doc_id"], r["item_id"]) for r in decontaminate.find_leaks(*data).collect()
    }
    whole = pairs()
    monkeypatch.setattr(decontaminate, "ITEMS_PER_BLOCK", 5)
    assert pairs() == whole == {(i, i % 12) for i in range(150)}


def slow_subsequence(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = row
        row = [0]
        for j, y in enumerate(b):
            row.append(last[j] + 1 if x == y else max(last[j + 1], row[j]))
    return row[-1]


def test_longest_common_subsequence():
    rng = random.Random(0)
    for _ in range(200):
        a = [rng.randrange(6) for _ in range(rng.randint(1, 40))]
        b = [rng.randrange(6) for _ in range(rng.randint(0, 60))]
        assert decontaminate.subsequence(decontaminate._masks(a), len(a), b) == slow_subsequence(a, b)


def test_awkward_rows(spark):
    docs = edges.documents(spark)
    items = spark.createDataFrame(
        [
            (1, "the quick brown fox jumps over the lazy dog near the river bank today and rests", "rests"),
            (2, None, None),
            (3, "", "x"),
            (None, "lorem ipsum dolor sit amet", None),
            (4, "--- !!", ""),
        ],
        "item_id long, text string, answer string",
    )
    found = decontaminate.find_leaks(docs, items).collect()
    assert sorted((r["doc_id"], r["item_id"]) for r in found) == [(1, 1), (2, 1), (2, 1)]
    assert decontaminate.find_leaks(docs, items.where("item_id > 9")).count() == 0
    assert decontaminate.find_leaks(edges.empty(spark), items).count() == 0
    assert decontaminate.keep_clean(docs, items).count() == len(edges.rows()) - 3
    assert decontaminate.keep_clean(docs, items.where("item_id > 9")).count() == len(edges.rows())


def test_short_and_reworded_items_of_a_large_benchmark(spark, sf_dir):
    rng = random.Random(7)
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").limit(400).collect()
    docs = [words(r["text"]) for r in rows]
    vocabulary = sorted({w for d in docs for w in d})
    some = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [some(n) for n in (6, 8, 12, 15, 20, 29) for _ in range(50)]
    expected = set()
    for n, item in enumerate(items):
        put = list(item)
        for at in rng.sample(range(len(put)), len(put) * 3 // 10 * (n % 2)):
            put[at] = f"new{at}"
        at = rng.randrange(len(docs[n]) + 1)
        docs[n][at:at] = put
        expected.add((n, n))
    others = [some(rng.randint(15, 29)) for _ in range(3000)]
    data = frames(spark, *([" ".join(t) for t in texts] for texts in (docs, items + others)))
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.find_leaks(*data).collect()}
    assert expected <= found
    assert len(found) < 1.1 * len(expected)


def test_no_match_in_a_passage_of_an_items_length_is_missed(monkeypatch):
    monkeypatch.setattr(decontaminate, "COSINE", 2.0)
    monkeypatch.setattr(decontaminate, "COUNTED", 2000)
    rng, hasher = random.Random(3), decontaminate._hasher()
    some = lambda n: [f"w{int(rng.random() ** 2 * 60)}" for _ in range(n)]
    hashed = lambda w: hasher.many(decontaminate._encoded([" ".join(w)]))[0].tolist()
    texts = [some(rng.randint(0, 150)) for _ in range(60)] + [[]]
    words = [hashed(some(rng.randint(1, 40))) for _ in range(40)]
    items = [decontaminate.Item(n, w, w[-1:]) for n, w in enumerate(words)]
    ones = decontaminate.np.ones(1 << decontaminate.BITS, dtype="float32")
    retriever = decontaminate.Retriever(items, ones[:, None], ones, ones)
    expected = set()
    for d, text in enumerate(map(hashed, texts)):
        for item in items:
            size = 6
            while size < len(item.words):
                size *= 2
            for at in range(0, len(text) if len(item.words) >= 6 else 0, size):
                near = text[at : at + 2 * size]
                share = slow_subsequence(item.words, near) / len(item.words)
                if share >= 0.6 or share >= 0.45 and item.answer[0] in near:
                    expected.add((d, item.item_id))
            size = len(item.words)
            runs = (text[k : k + size] for k in range(len(text)))
            if size < 6 and any(run == item.words for run in runs):
                expected.add((d, item.item_id))
    found = {f[:2] for f in retriever.find([" ".join(t) for t in texts])}
    assert found == expected and len(expected) > 50


def test_items_of_few_words_are_found_word_for_word(spark):
    rng = random.Random(8)
    vocabulary = [f"{a}{b}{c}" for a in "bdfgklmn" for b in "aeiou" for c in "lmnrstvz"]
    docs = [[rng.choice(vocabulary) for _ in range(rng.randint(5, 120))] for _ in range(120)]
    items, expected = [], set()
    for number in range(60):
        size = number % 5 + 1
        item = [f"q{number}x{k}" if k == 0 else rng.choice(vocabulary) for k in range(size)]
        items.append(item)
        for d in rng.sample(range(120), 2):
            at = rng.randint(0, len(docs[d]))
            docs[d][at:at] = item
    for d, doc in enumerate(docs):
        for number, item in enumerate(items):
            if any(doc[k : k + len(item)] == item for k in range(len(doc))):
                expected.add((d, number))
    table, benchmark = frames(
        spark, [" ".join(d) for d in docs], [" ".join(i) for i in items]
    )
    found = decontaminate.find_leaks(table, benchmark).collect()
    whole = {(r["doc_id"], r["item_id"]) for r in found if r["overlap"] == 1.0}
    assert expected <= whole and len(expected) > 100
