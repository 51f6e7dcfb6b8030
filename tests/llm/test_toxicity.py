"""Segments against brute force, and rows that were not learnt from."""

import math
import random
import zlib

import edges
import pytest

from seatwise.llm import toxicity


def slow_segments(scores):
    """All maximal segments by definition: the best one, then what lies beside it."""
    best = max(
        (
            (sum(scores[a:b]), -(b - a), a, b)
            for a in range(len(scores))
            for b in range(a + 1, len(scores) + 1)
        ),
        default=None,
    )
    if best is None or best[0] <= 1e-12:
        return []
    total, _, a, b = best
    left = [(s, x, y) for s, x, y in slow_segments(scores[:a])]
    right = [(s, x + b, y + b) for s, x, y in slow_segments(scores[b:])]
    return left + [(total, a, b - 1)] + right


@pytest.mark.parametrize("seed", range(40))
def test_segments_are_the_maximal_ones(seed):
    rng = random.Random(seed)
    scores = [rng.choice([-0.1, -0.1, -0.1, rng.uniform(0.05, 2)]) for _ in range(rng.randint(0, 30))]
    hits = [(i, s) for i, s in enumerate(scores) if s > 0]
    got = [(round(s, 6), a, b) for s, a, b in toxicity.segments(hits, 0.1)]
    assert got == [(round(s, 6), a, b) for s, a, b in slow_segments(scores)]


def test_the_decay_rate_solves_its_equation():
    scores = {"a": 1.5, "b": 3.0, "c": 2.25}
    shares = {"a": 0.004, "b": 0.0005, "c": 0.001}
    rate = toxicity.decay_rate(scores, shares)
    known = sum(shares.values())
    mean = sum(shares[w] * math.exp(rate * scores[w]) for w in scores)
    assert mean + (1 - known) * math.exp(-rate * toxicity.DRIFT) == pytest.approx(1, abs=1e-9)
    assert toxicity.decay_rate({}, {}) == 1.0


def test_the_lexicon_is_the_log_odds_under_the_prior(spark):
    rows = [("bad", 40, 3), ("worse", 25, 0), ("fine", 30, 900), ("rare", 1, 0), ("clean", 0, 80)]
    counts = spark.createDataFrame(rows, "word string, toxic_n long, clean_n long")
    toxic, clean = sum(r[1] for r in rows), sum(r[2] for r in rows)
    bad = toxic / (toxic + clean)
    expected = {}
    for word, t, c in rows:
        prior = toxicity.PRIOR_EACH + toxicity.PRIOR_WORDS * (t + c) / (toxic + clean)
        a, b = t + prior * bad, c + prior * (1 - bad)
        all_a, all_b = toxic + toxicity.PRIOR_WORDS * bad, clean + toxicity.PRIOR_WORDS * (1 - bad)
        odds, deviation = math.log(a / (all_a - a)) - math.log(b / (all_b - b)), math.sqrt(1 / a + 1 / b)
        if t and odds - min(toxicity.CAUTIONS) * deviation > toxicity.LEAST_SCORE:
            expected[word] = (odds, deviation, b / all_b)
    got = toxicity.lexicon(counts)
    assert {w: pytest.approx(rest) for w, *rest in got} == {w: list(e) for w, e in expected.items()}
    assert "fine" not in expected and "clean" not in expected and expected
    strict = toxicity.cautious(got, 3.0).lexicon
    assert strict == {
        w: pytest.approx(o - 3 * d) for w, (o, d, _) in expected.items() if o - 3 * d > toxicity.LEAST_SCORE
    }


def test_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    truth = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    rows = toxicity.score_documents(docs, labels).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)
    held = [r for r in rows if r["held_out"] and r["doc_id"] in truth]
    toxic = [r["predicted"] for r in held if truth[r["doc_id"]]]
    clean = [r["predicted"] for r in held if not truth[r["doc_id"]]]
    assert sum(toxic) / len(toxic) > 0.9
    assert sum(clean) / len(clean) < 0.01


def test_awkward_rows(spark):
    docs = edges.documents(spark)
    labels = spark.createDataFrame(
        [(1, 0, 1), (1, 0, 0), (2, 1, None), (None, 1, 1), (6, 1, 0), (99, 0, 1)],
        "doc_id long, quality int, toxic int",
    )
    rows = toxicity.score_documents(docs, labels).collect()
    assert len(rows) == len(edges.rows())
    assert len({r["score"] for r in rows if r["doc_id"] in (3, 4, 5)}) == 1
    none = labels.where("toxic > 5")
    assert all(r["score"] < 1e-6 for r in toxicity.score_documents(docs, none).collect())
    assert toxicity.score_documents(edges.empty(spark), labels).count() == 0
