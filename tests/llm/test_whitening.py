import math

import numpy as np

from marquee.llm.common import importable
from marquee.llm.whitening import leading_components, whiten

VECTORS = "vec_id bigint, embedding array<float>, id string, x string, component string"


def table(spark, vectors):
    importable(spark)
    return spark.createDataFrame([(k, None if v is None else [None if c is None else float(c) for c in v], "x", "x", "x") for k, v in vectors], VECTORS)


def expected(vectors):
    """Eigenvectors of the whole covariance, and the exact numbers."""
    x = np.array([[math.floor(1024 * float(np.float32(c))) + 100_000 for c in v] for _, v in vectors], np.int64)
    n, s = len(x), x.sum(0)
    moved = x - s / n
    cov = moved.T @ moved / n
    values, basis = np.linalg.eigh(cov)
    return n, [sum((n * int(c) - int(t)) ** 2 for c, t in zip(r, s, strict=True)) for r in x], moved, values[::-1], basis[:, ::-1], np.trace(cov)


def check(spark, vectors, count=8, sloppy=1e-7):
    n, deviation, moved, values, basis, trace = expected(vectors)
    scores = moved @ basis[:, :count] / np.sqrt(values[:count])
    rows = whiten(table(spark, vectors)).collect()
    place = {i: k for k, (i, _) in enumerate(vectors)}
    assert len(rows) == len(vectors) * count
    ours = np.zeros_like(scores)
    for r in rows:
        ours[place[r["vec_id"]], r["component"] - 1] = r["whitened"]
        assert r["n"] == n and r["deviation"] == deviation[place[r["vec_id"]]]
        assert abs(r["explained"] / (values[r["component"] - 1] / trace) - 1) < 1e-9
        assert r["identity_error"] < 1e-9
    signs = np.sign((ours * scores).sum(0))
    assert np.abs(ours * signs - scores).max() < sloppy


def test_like_the_whole_covariance(spark):
    rng = np.random.default_rng(3)
    vectors = [(k, v) for k, v in enumerate(rng.standard_normal((700, 40)) * np.linspace(3, 1, 40))]
    check(spark, vectors)


def test_flat_spectrum_and_common_vector(spark):
    rng = np.random.default_rng(4)
    vectors = [(k, v / np.linalg.norm(v)) for k, v in enumerate(rng.standard_normal((3000, 48)))]
    vectors += [(3000 + k, vectors[0][1]) for k in range(1500)]
    check(spark, vectors)


def test_few_dimensions_and_low_rank(spark):
    rng = np.random.default_rng(5)
    check(spark, [(k, v) for k, v in enumerate(rng.standard_normal((50, 3)))], 3)
    flat = [(k, [a, 2.0, a, a]) for k, a in enumerate([0.5, 1.0, 2.0, 4.0])]
    assert sorted({r["component"] for r in whiten(table(spark, flat)).collect()}) == [1]
    assert whiten(table(spark, [(1, [1.0, 2.0])] * 5)).count() == 0


def test_odd_rows(spark):
    rng = np.random.default_rng(6)
    good = [(k, v) for k, v in enumerate(rng.standard_normal((60, 5)))]
    bad = [(100, None), (101, []), (102, [1.0, None, 1.0, 1.0, 1.0]), (103, [1.0, math.nan, 1.0, 1.0, 1.0]), (104, [-math.inf, 0.0, 0.0, 0.0, 0.0]), (105, [1.0, 2.0]), (106, [1e38] * 5)]
    repeated = [*good, (None, good[0][1]), (3, good[3][1])]
    rows = whiten(table(spark, repeated + bad)).collect()
    assert len(rows) == 62 * 5 and {r["n"] for r in rows} == {62}
    assert sum(r["vec_id"] is None for r in rows) == 5 and sum(r["vec_id"] == 3 for r in rows) == 10
    assert whiten(table(spark, [])).count() == whiten(table(spark, bad[:2])).count() == 0


def test_a_deviation_beyond_a_long_is_null(spark):
    big = [(1, [float(2**40), 0.0]), (2, [0.0, 1.0]), (3, [5.0, 2.0])]
    assert {r["vec_id"]: r["deviation"] for r in whiten(table(spark, big)).collect()} == {1: None, 2: None, 3: None}


def test_close_eigenvalues_are_told_apart():
    rng = np.random.default_rng(8)
    basis = np.linalg.qr(rng.standard_normal((200, 200)))[0]
    values = np.concatenate([[5, 5 - 1e-6, 4], np.linspace(3, 2.9, 197)])
    cov = basis * values @ basis.T
    found, vectors = leading_components(lambda q: cov @ q, 200, 8)
    assert np.allclose(found, values[:8], rtol=1e-12)
    assert np.abs(np.abs((vectors[:, :3] * basis[:, :3]).sum(0)) - 1).max() < 1e-9
