"""Places of phrases against a plain search, and notices by their diagonals."""

import re

import edges

from seatwise.llm import licenses


def slow(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)
    places = [
        (i, label)
        for label, phrase in licenses.PHRASES
        for i in range(len(words))
        if words[i : i + len(phrase.split())] == phrase.split()
    ]
    starts = [i for i, _ in places]
    labels = ",".join(sorted({y for _, y in places}))
    return len(words), len(places), min(starts, default=None), max(starts, default=None), labels


def found(docs):
    return {r["doc_id"]: r for r in licenses.scan(docs).collect()}


def test_whole_table_against_a_plain_search(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = found(docs)
    assert len(got) == docs.count()
    for r in docs.collect():
        assert tuple(got[r["doc_id"]])[1:6] == slow(r["text"])


def test_phrases_repeated_overlapping_and_disguised(spark):
    texts = [
        "Under the MIT License! under the mit license under the mit license",
        "cc-by-nc, CC BY NC cc by nc by nc",
        "under the mıt license; under the mité license",
        "apache Kind license version 2",
        "Apache License, Version 2.0 and licensed under the apache license version 20",
        "under the mit",
        "İ under the mit license",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = found(docs)
    for i, text in enumerate(texts):
        assert tuple(got[i])[1:6] == slow(text), text


def test_notices_with_words_put_in_or_left_out(spark):
    notice = dict((y, t) for y, t in licenses.NOTICES)["bsd"].split()
    gap = notice[:9] + ["also", "very"] + notice[9:]
    texts = [
        " ".join(notice),
        " ".join(gap),
        " ".join(notice[:6]),
        " ".join(reversed(notice)),
        " ".join(["filler"] * 500 + notice + ["filler"] * 500 + gap),
    ]
    got = found(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert [got[i]["labels"] for i in range(5)] == ["bsd", "bsd", "", "", "bsd"]
    assert got[0]["score"] == 1.0 and 0.6 <= got[1]["score"] < 1 and got[2]["score"] == 0
    assert all(got[i]["base_labels"] == "" and got[i]["n_base"] == 0 for i in range(5))


def test_a_notice_behind_its_own_first_words_keeps_its_label(spark):
    notice = "No part of this publication may be reproduced"
    texts = ["All rights reserved. " * n + notice for n in (1, 2, 3, 9)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = {r["doc_id"]: r["labels"] for r in licenses.scan(docs).collect()}
    assert labels[0] and set(labels.values()) == {labels[0]}


def test_awkward_rows(spark):
    result = licenses.scan(edges.documents(spark)).collect()
    got = sorted((r["doc_id"] or -1, *tuple(r)[1:6]) for r in result)
    assert [x[:3] for x in got] == sorted((i or -1, *slow(t)[:2]) for i, t, *_ in edges.rows())
    assert licenses.scan(edges.empty(spark)).count() == 0
    many = spark.createDataFrame([(1, "under the mit license " * 3000)], "doc_id long, text string")
    row = licenses.scan(many).first()
    assert (row["n_base"], row["first_word"], row["last_word"]) == (3000, 0, 11996)


def test_no_python_in_the_plan(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    text = licenses.scan(docs)._jdf.queryExecution().executedPlan().toString()
    assert not [w for w in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop") if w in text]
