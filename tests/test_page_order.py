"""Chains of pages put in order by their tokens."""

import random

import pytest

from seatwise.sources import page_order

SCHEMA = "g string, Token string, NextToken string, load int"


def frame(spark, *pages):
    return spark.createDataFrame([(*p, 1) for p in pages], SCHEMA).repartition(3)


def chain(g, names):
    return [(g, a, b) for a, b in zip([None, *names], [*names, None])]


def problems(spark, *pages):
    rows = page_order.chain_problems(frame(spark, *pages), "g").collect()
    return {(r["g"], r["problem"]): (r["token"], r["pages"]) for r in rows}


def test_long_and_short_chains_in_any_order(spark):
    rng = random.Random(1)
    names = [f"t{i}" for i in range(300)]
    rng.shuffle(names)
    pages = chain("long", names) + chain("one", []) + chain("two", [" x "])
    rng.shuffle(pages)
    order = page_order.page_order(frame(spark, *pages), "g").collect()
    got = {(r["g"], r["token"]): r["page"] for r in order}
    expected = {("long", t): i for i, t in enumerate(["", *names], 1)}
    assert got == expected | {("one", ""): 1, ("two", ""): 1, ("two", "x"): 2}
    assert problems(spark, *pages) == {}


def test_every_problem_is_named(spark):
    pages = [
        *chain("whole", ["a", "b"]),
        ("gap", None, "a"), ("gap", "b", None),
        ("late", "a", "b"), ("late", "b", ""),
        *chain("twice", ["a", "b"]), ("twice", "a", "b"),
        *chain("fork", ["a", "b"]), ("fork", "a", "c"), ("fork", "c", None),
        ("ring", None, ""), ("ring", "a", "b"), ("ring", "b", "c"), ("ring", "c", "a"),
        *chain("back", ["a", "b"])[:-1], ("back", "b", "a"),
        ("self", None, "a"), ("self", "a", "a"),
    ]
    assert problems(spark, *pages) == {
        ("gap", "gap"): ("a", 1), ("gap", "cut off"): ("b", 1),
        ("late", "first page missing"): ("a", 1), ("late", "cut off"): ("a", 1),
        ("twice", "page repeated"): ("a", 1), ("fork", "fork"): ("a", 1),
        ("ring", "cycle"): ("a", 3), ("back", "token repeated"): ("a", 1),
        ("self", "token repeated"): ("a", 1),
    }


def test_pages_are_numbered_only_if_whole(spark):
    whole = frame(spark, *chain("g1", ["a"])).selectExpr("*", "0 AS page")
    rows = page_order.in_token_order(whole, "g").collect()
    assert sorted((r["Token"] or "", r["page"], r["load"]) for r in rows) == [("", 1, 1), ("a", 2, 1)]
    broken = frame(spark, ("g1", None, "a")).selectExpr("*", "0 AS page")
    with pytest.raises(ValueError, match="g1: gap at token 'a'"):
        page_order.in_token_order(broken, "g")


def test_nothing_landed(spark):
    assert page_order.page_order(frame(spark), "g").count() == 0
    assert problems(spark) == {}


def test_rounds_grow_with_the_logarithm(spark, monkeypatch):
    written = []
    original = page_order._written
    monkeypatch.setattr(page_order, "_written", lambda df: written.append(1) or original(df))
    page_order.page_order(frame(spark, *chain("g", [str(i) for i in range(255)])), "g").count()
    assert len(written) <= 2 + 9
