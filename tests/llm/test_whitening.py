"""Whitening against dense eigenvectors of the whole covariance."""

import math
import random

import numpy as np
import pytest

from seatwise.llm import whitening

SCHEMA = "vec_id long, embedding array<double>, label int, x string, n string, component string"


def run(spark, rows, parts=3):
    frame = spark.createDataFrame([(i, v, 1, "x", "n", "c") for i, v in rows], SCHEMA)
    return whitening.whitened(frame.repartition(parts))


def brute(rows, most=4):
    good = [
        (i, [math.floor(256 * c) for c in v])
        for i, v in rows
        if v is not None and all(c is not None and math.isfinite(c) for c in v)
    ]
    d = max(len(v) for _, v in good)
    good = [(i, v + [0] * (d - len(v))) for i, v in good]
    x = np.array(sorted({tuple(v) for _, v in good}), dtype=float)
    n, s = len(x), [int(t) for t in x.sum(axis=0)]
    v = (x - x.mean(axis=0)).T @ (x - x.mean(axis=0)) / n
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(most, int((values > 1e-13 * values[0]).sum())) if values[0] > 0 else 0
    out = {}
    for i, row in good:
        away = sum((n * a - b) ** 2 for a, b in zip(row, s))
        white = (np.array(row) - x.mean(axis=0)) @ vectors[:, :k] / np.sqrt(values[:k])
        out.setdefault(i, []).append((n, away, white, values[:k] / np.trace(v)))
    return out


def check(spark, rows, close=1e-9):
    expected = brute(rows)
    got = {}
    signs = {}
    for r in run(spark, rows).collect():
        got.setdefault((r["vec_id"], r["component"]), []).append(r)
        assert r["identity_error"] <= 1e-9
    for i, copies in expected.items():
        for k in range(len(copies[0][2])):
            found = got.pop((i, k + 1))
            assert len(found) == len(copies)
            n, away, white, share = copies[0]
            for r in found:
                assert (r["n"], r["deviation"]) == (n, min(away, 2**63 - 1))
                assert r["explained"] == pytest.approx(share[k], rel=1e-9)
                if abs(white[k]) > 1e-3:
                    sign = math.copysign(1, white[k] * r["whitened"])
                    assert signs.setdefault(k, sign) == sign
                assert abs(abs(r["whitened"]) - abs(white[k])) <= close * max(1, abs(white[k]))
    assert not got


def vectors(n, d, seed, scales=None):
    rng = np.random.default_rng(seed)
    x = rng.normal(0, 1, (n, d)) * (np.linspace(3, 0.1, d) if scales is None else scales)
    return [(i, v.tolist()) for i, v in enumerate(x)]


def test_against_dense_eigenvectors(spark):
    check(spark, vectors(300, 12, 1))


def test_more_dimensions_than_the_block_has_columns(spark):
    check(spark, vectors(500, 48, 2), 1e-8)


def test_copies_count_once_and_awkward_rows(spark):
    rows = vectors(60, 5, 3)
    rows += [rows[4]] * 200 + [(1000 + i, rows[5][1]) for i in range(50)]
    rows += [
        (None, [1.0] * 5), (2000, None), (2001, [1.0, None, 0.0, 0.0, 0.0]),
        (2002, [math.nan] * 5), (2003, [math.inf] * 5), (2004, []), (2005, [2.0, 1.0]),
    ]
    check(spark, rows)


def test_large_numbers_stay_exact(spark):
    rng = random.Random(4)
    rows = [(i, [rng.uniform(-1e6, 1e6) for _ in range(4)]) for i in range(90)]
    check(spark, rows)


def test_less_spread_than_components(spark):
    line = [(i, [float(i), 2.0 * i, 0.0]) for i in range(20)]
    got = run(spark, line).collect()
    assert {r["component"] for r in got} == {1} and len(got) == 20
    check(spark, line)
    assert run(spark, [(1, [1.0, 2.0])] * 3).count() == 0
    assert run(spark, [(1, [])]).count() == 0
    empty = run(spark, [])
    assert empty.count() == 0
    assert empty.columns == "vec_id component n deviation whitened explained identity_error".split()


def test_filter_damps_what_lies_below_the_cut():
    values = np.array([9.0, 8.0, 3.0, 2.0, 1.0, 0.0])
    out = whitening.filtered(lambda q: values[:, None] * q, np.eye(6), 0.0, 3.0, 9.0)
    size = np.abs(np.diag(out))
    assert size[0] == pytest.approx(1, rel=1e-6) and size[1] > 0.1
    assert (size[2:] < 1e-8).all()


def test_values_are_not_returned_before_they_are_certified(spark, monkeypatch):
    rows = vectors(400, 40, 6, np.linspace(1.2, 1.0, 40))
    frame = spark.createDataFrame([(i, v, 1, "x", "n", "c") for i, v in rows], SCHEMA)
    monkeypatch.setattr(whitening, "MOST_CYCLES", 1)
    monkeypatch.setattr(whitening, "BLOCK", 6)
    with pytest.raises(RuntimeError, match="not certified"):
        fit = frame.select(whitening.quantised(frame["embedding"]).alias("x"))
        whitening.leading(fit, 400, np.zeros(40), block=6)
