"""Whitening against numpy's eigenvectors and exact integer sums."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import whitening as W

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def vectors(n=300, d=24, seed=3):
    rng = np.random.default_rng(seed)
    base = rng.standard_normal((n, d)) * np.linspace(3, 0.3, d)
    return [(i, [float(np.float32(c)) for c in row], 0) for i, row in enumerate(base)]


@pytest.fixture(scope="module")
def rows():
    out = vectors()
    out += [(1000 + i, out[5][1], 1) for i in range(40)]  # copies count once
    out += [(2000, None, 0), (2001, [None] + out[0][1][1:], 0), (2002, [math.nan] + out[0][1][1:], 0)]
    out += [(2003, [math.inf] + out[0][1][1:], 0), (2004, [], 0), (2005, out[0][1][:5], 0), (None, out[1][1], 0)]
    return out


def expected(rows, d):
    kept = [(i, v) for i, v, _ in rows if v is not None and len(v) == d and all(c is not None and math.isfinite(c) for c in v)]
    xs = [[math.floor(64 * c) + 1000000 for c in v] for _, v in kept]
    fit = sorted({tuple(x) for x in xs})
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    centred = np.array([[float(n * c - s) / n for c, s in zip(x, sums, strict=True)] for x in fit])
    e, q = np.linalg.eigh(centred.T @ centred / n)
    return kept, xs, n, sums, e[::-1], q[:, ::-1]


def check(got, rows, d):
    kept, xs, n, sums, e, q = expected(rows, d)
    k = min(16, d)
    assert len(got) == len(kept) * k
    by = {}
    for r in got:
        by.setdefault(r["component"], []).append(r)
    assert sorted(by) == list(range(1, k + 1))
    want = {}
    for (i, _), x in zip(kept, xs, strict=True):
        dev = sum((n * c - s) ** 2 for c, s in zip(x, sums, strict=True))
        want[i] = (dev, np.array([float(n * c - s) / n for c, s in zip(x, sums, strict=True)]) @ q)
    for j, mine in by.items():
        sign = None
        for r in mine:
            dev, y = want[r["vec_id"]]
            assert r["n"] == n and r["deviation"] == dev and r["identity_error"] <= 1e-9
            assert r["explained"] == pytest.approx(e[j - 1] / e.sum(), rel=1e-9)
            w = y[j - 1] / math.sqrt(e[j - 1])
            if sign is None and abs(w) > 1e-3:
                sign = math.copysign(1, w * r["whitened"])
            if sign:
                assert r["whitened"] == pytest.approx(sign * w, abs=1e-8)


def test_equals_numpy(spark, rows):
    table = spark.createDataFrame(rows, SCHEMA)
    check(W.whiten(table.repartition(7)).collect(), rows, 24)


def test_block_smaller_than_the_space(spark):
    rows = vectors(400, 60, 8)
    check(W.whiten(spark.createDataFrame(rows, SCHEMA)).collect(), rows, 60)


def test_few_dimensions_and_few_vectors(spark):
    rows = vectors(50, 3)
    check(W.whiten(spark.createDataFrame(rows, SCHEMA)).collect(), rows, 3)
    got = W.whiten(spark.createDataFrame(vectors(3, 20), SCHEMA)).collect()  # rank 2
    assert len(got) == 48 and all((r["whitened"] is None) == (r["component"] > 2) for r in got)
    assert all(r["identity_error"] < 1e-9 for r in got)
    one = W.whiten(spark.createDataFrame([(1, [0.5, 0.25], 0)] * 3, SCHEMA)).collect()
    assert len(one) == 6 and all(r["whitened"] is None and r["explained"] is None and r["deviation"] == 0 for r in one)


def test_large_offsets_and_wide_deviations(spark):
    rows = [(i, [1e12 + i * 1e9, float(i % 7)], 0) for i in range(40)]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    kept, xs, n, sums, e, _ = expected(rows, 2)
    for r in W.whiten(table).collect():
        dev = sum((n * c - s) ** 2 for c, s in zip(xs[r["vec_id"]], sums, strict=True))
        assert r["deviation"] == (dev if dev < 2**63 else None)
    huge = spark.createDataFrame([(1, [1e300, 0.0], 0), (2, [-1e300, 1.0], 0), (3, [0.0, 2.0], 0)], table.schema)
    assert W.whiten(huge).count() == 6


@pytest.mark.parametrize(
    "spectrum", [[1e6, *(60 - 0.1 * np.arange(63))], 10.0 ** -np.arange(64), [5.0] * 20 + [1.0] * 44, [3, 2, 1] + [0] * 61]
)
def test_hard_spectra(spectrum):
    turn = np.linalg.qr(np.random.default_rng(0).standard_normal((64, 64)))[0]
    v = (turn * np.array(spectrum, float)) @ turn.T
    values, q = W.filtered_subspace(lambda m: v @ m, 64)
    assert np.allclose(values, spectrum[:16], atol=1e-12 * spectrum[0])
    assert np.linalg.norm(v @ q - q * values, axis=0).max() <= 1e-9 * spectrum[0]
    assert np.allclose(q.T @ q, np.eye(16), atol=1e-12)


def test_empty_and_extra_columns(spark, rows):
    table = spark.createDataFrame(rows, SCHEMA)
    assert W.whiten(table.limit(0)).count() == 0
    assert W.whiten(table.where("vec_id BETWEEN 2000 AND 2004")).count() == 0
    odd = table.withColumns({c: F.lit("z") for c in ("x", "v", "i", "c", "n", "component")})
    assert W.whiten(odd).count() == W.whiten(table).count()
