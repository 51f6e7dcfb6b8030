"""Accuracy on held-out rows, and texts without a language."""

import random
import zlib

import edges
import numpy as np

from seatwise.llm import language


def test_held_out_accuracy(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    truth = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    result = language.identify(docs).collect()
    assert len(result) == len(truth)
    for r in result:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1
    held = [r for r in result if r["held_out"]]
    right = sum(r["lang_pred"] == truth[r["doc_id"]] for r in held)
    assert right / len(held) > 0.97


def test_labels_of_held_out_rows_do_not_matter(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(300)
    spoiled = docs.selectExpr(
        "doc_id", "text", "if(crc32(cast(doc_id AS string)) % 4 = 2, 'zz', lang) AS lang"
    )
    rows = lambda d: sorted(tuple(r) for r in language.identify(d).collect())
    assert rows(docs) == rows(spoiled)


def test_presence_does_not_depend_on_the_pieces_a_text_is_read_in(monkeypatch):
    text = "Der schnelle braune Fuchs springt " * 50
    whole = unpacked(text)
    monkeypatch.setattr(language, "CHUNK_CHARS", 64)
    assert (whole <= unpacked(text)).all()


def unpacked(text):
    return np.unpackbits(np.frombuffer(language.packed_presence(text), dtype=np.uint8)) > 0


def test_scores_are_those_of_the_kernel_taken_pair_by_pair():
    rng = random.Random(4)
    langs = ["aa", "bb", "cc"]
    stems = {y: ["".join(rng.choices("abcdefgh"[i * 2 : i * 2 + 4], k=4)) for _ in range(9)] for i, y in enumerate(langs)}
    make = lambda y: " ".join(rng.choices(stems[y], k=rng.randint(3, 20)))
    data = [(make(y), y) for _ in range(30) for y in langs]
    model = language.fit([language.packed_presence(t) for t, _ in data], [y for _, y in data])

    def places(text):
        return [set(p.tolist()) for p in np.split(language.gram_places(text), edges_of(text))]

    def edges_of(text):
        found = language.gram_places(text) >> language.BITS
        return [int(np.searchsorted(found, i)) for i in range(1, len(language.GRAMS))]

    def kernel(a, b):
        share = 0.0
        for x, y in zip(places(a), places(b)):
            share += len(x & y) / (len(x) * len(y)) ** 0.5 / len(language.GRAMS)
        return share

    marks = [t for t, _ in data][: language.LANDMARKS]
    inner = np.array([[kernel(a, b) for b in marks] for a in marks])
    goal = np.array([[1.0 if y == z else -1.0 for z in langs] for _, y in data])
    ridge = language.RIDGE * len(data)
    alpha = np.linalg.solve(inner.T @ inner + ridge * inner + 1e-6 * np.eye(len(marks)), inner.T @ goal)
    for text in [make(y) for y in langs for _ in range(5)]:
        slow = np.array([kernel(text, m) for m in marks]) @ alpha
        fast = language.presence([language.packed_presence(text)])[0] @ model.weights
        assert np.allclose(slow, fast, atol=2e-3)


def test_whole_texts_are_learnt_from(spark):
    filler = "0 1 2 3 " * 4000
    rows = [(i, filler + ("lorem ipsum dolor " if i % 2 else "wrzqk plugh xyzzy ") * 400, "aa" if i % 2 else "bb") for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    held = [r for r in language.identify(docs).collect() if r["held_out"]]
    assert held and all(r["lang_pred"] == ("aa" if r["doc_id"] % 2 else "bb") for r in held)


def test_more_languages_than_rows_to_learn_from(spark):
    rows = [(i, f"word{i} text", f"l{i % 30:02}") for i in range(90)]
    docs = spark.createDataFrame(rows + [(99, "more of it", "l07")], "doc_id long, text string, lang string")
    texts, langs = language.training_sample(docs, 10)
    assert len(texts) == len(langs) <= 20 and len(set(langs)) <= 10


def test_awkward_rows(spark):
    docs = edges.documents(spark).selectExpr("*", "'x' AS extra").replace("none", "none")
    labelled = docs.selectExpr("doc_id", "text", "if(doc_id % 2 = 0, 'en', 'de') AS lang", "score")
    found = {r["doc_id"]: r for r in language.identify(labelled).collect()}
    assert {found[i]["lang_pred"] for i in (3, 4, 5, 7)} == {"und"}
    assert found[1]["lang_pred"] in ("en", "de")
    assert language.identify(edges.empty(spark)).count() == 0
    nothing = language.identify(edges.documents(spark))
    assert {r["lang_pred"] for r in nothing.collect()} == {"und"}
    kept = language.keep_identified(labelled)
    assert kept.columns == labelled.columns
    assert {r["doc_id"] for r in kept.collect()} == {1, 2, 6, 8, None}


def test_texts_stay_where_there_is_nothing_to_learn_from(spark):
    kept = language.keep_identified(edges.documents(spark))
    assert {r["doc_id"] for r in kept.collect()} == {1, 2, 6, 8, None}
    assert language.keep_identified(edges.empty(spark)).count() == 0
