"""Encoding against the library on whole texts."""

import hashlib
import random

import edges
import numpy as np
import pytest
from tokenizers import Tokenizer

from seatwise.llm import bpe
from seatwise.llm.queries import tokenizer_path


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(tokenizer_path())


def expected(tokenizer, text):
    ids = tokenizer.encode(text or "", add_special_tokens=False).ids
    decoded = tokenizer.decode(ids, skip_special_tokens=False)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return len(ids), sha(" ".join(map(str, ids))), sha(decoded)


PIECES = [
    "hello", "World", " ", "\n", "  ", "'s", "'", "''re", "!!", "..", "=", "==", "123", "4", "é",
    "é", "́", "ÉTÉ", "中文", "\U0001f600", "한", "İ", "Σς",
    "<|endoftext|>", "<|startof", "text|>", "a" * 30, "ab" * 20, "-" * 25, " ", "​", "½", "_x_",
    "supercalifragilistic", "नि", "x̧́", "don't", "WE'LL",
]


def some_text(rng, most=60):
    return "".join(rng.choices(PIECES, k=rng.randint(0, most)))


@pytest.mark.parametrize("seed", range(150))
def test_joined_leaves_equal_the_whole(tokenizer, seed):
    rng = random.Random(seed)
    text = some_text(rng)
    leaves = bpe.halve(text, rng.choice([5, 17, 40]))
    assert "".join(part for _, part in leaves) == text
    nodes = []
    for first, part in leaves:
        tokens = bpe.unpack(bpe.pack(bpe.encode_span(tokenizer, part)))
        nodes.append((first, tokens + np.array([0, first, first, 0])))
    joined = bpe.join_tree(tokenizer, text, nodes)
    assert joined[:, 0].tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_every_latin_letter_alone_between_letters_and_after_a_sign(tokenizer):
    encoder = bpe.Encoder(tokenizer_path())
    texts = []
    for code in range(0x250):
        c = chr(code)
        texts += [c, f"a{c}b", f"({c}li)", f"{c}kwan {c}", f"x {c}{c.lower()}{c.upper()}"]
    rng = random.Random(5)
    letters = [chr(code) for code in range(0x250)]
    texts += ["".join(rng.choices(letters, k=rng.randint(1, 40))) for _ in range(2000)]
    for at in range(0, len(texts), 37):
        some = texts[at : at + 37]
        for text, (ids, decoded) in zip(some, encoder.texts(some), strict=True):
            known = tokenizer.encode(text, add_special_tokens=False).ids
            assert ids == " ".join(map(str, known)), repr(text)
            assert decoded == tokenizer.decode(known, skip_special_tokens=False)


@pytest.mark.parametrize("unit", ["a", "abc", "=", "'s", "中", "é", "zq9", "́", "Ab!"])
def test_long_unsplit_text(tokenizer, unit):
    text = unit * 3000
    nodes = []
    for first, part in bpe.halve(text, 256):
        tokens = bpe.encode_span(tokenizer, part)
        nodes.append((first, tokens + np.array([0, first, first, 0])))
    joined = bpe.join_tree(tokenizer, text, nodes)
    assert joined[:, 0].tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_words_from_the_cache_equal_the_library(tokenizer):
    encoder = bpe.Encoder(tokenizer_path())
    rng = random.Random(7)
    for _ in range(300):
        text = some_text(rng)
        ids, decoded = encoder.text(text)
        found = tokenizer.encode(text, add_special_tokens=False).ids
        assert ids == " ".join(map(str, found))
        assert decoded == tokenizer.decode(found, skip_special_tokens=False)


@pytest.mark.parametrize("leaf", [64, 65536])
def test_awkward_rows(spark, tokenizer, leaf):
    result = bpe.encode_documents(edges.documents(spark), tokenizer_path(), leaf).collect()
    got = sorted((r["doc_id"] or -1, *tuple(r)[1:]) for r in result)
    assert got == sorted((i or -1, *expected(tokenizer, t)) for i, t, *_ in edges.rows())
    assert bpe.encode_documents(edges.empty(spark), tokenizer_path(), leaf).count() == 0


def test_whole_table(spark, sf_dir, tokenizer):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    result = bpe.encode_documents(docs, tokenizer_path(), leaf=4096).collect()
    assert len(result) == len(texts)
    for r in result:
        assert tuple(r)[1:] == expected(tokenizer, texts[r["doc_id"]])
