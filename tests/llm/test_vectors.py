"""Whitening against exact fractions and plain eigenvectors."""

import math
from fractions import Fraction

import numpy as np
import pytest

from surveylake.llm import whitening
from surveylake.llm.common import table
from surveylake.llm.queries import QUERIES
from surveylake.llm.whitening import WIDE, eigen, products

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def steps(vector):
    if vector is None or not vector or any(c is None or not math.isfinite(c) for c in vector):
        return None
    return tuple(math.floor(64 * c) + 1_000_000 for c in vector)


def compare(found, rows, components=16):
    """All columns of the result against plain figures of the rows."""
    held = [(key, steps(v)) for key, v, *_ in rows if steps(v) is not None]
    fit = np.array(sorted({x for _, x in held}), object)
    n, sums = len(fit), fit.sum(0)
    d = n * fit - sums
    scatter = d.T @ d
    exact = np.array([[float(Fraction(int(v), n**3)) for v in row] for row in scatter])
    values, vectors = np.linalg.eigh(exact)
    values, vectors = values[::-1], vectors[:, ::-1]
    kept = [k for k in range(min(components, len(values))) if values[k] > values[0] * 1e-12]
    got = {}
    for r in found:
        got.setdefault((r["vec_id"], r["deviation"]), []).append(r)
    want = {}
    for key, x in held:
        want.setdefault((key, sum((n * v - s) ** 2 for v, s in zip(x, sums))), []).append(x)
    assert got.keys() == want.keys()
    signs = {}
    for at, xs in want.items():
        assert len(got[at]) == len(xs) * len(kept) and {r["component"] for r in got[at]} == {k + 1 for k in kept}
        centred = np.array([float(Fraction(int(v) * n - int(s), n)) for v, s in zip(xs[0], sums)])
        for r in got[at]:
            k = r["component"] - 1
            plain = centred @ vectors[:, k] / math.sqrt(values[k])
            assert r["n"] == n and math.isclose(r["explained"], values[k] / np.trace(exact), rel_tol=1e-9) and r["identity_error"] < 1e-9
            apart = min((abs(values[k] - values[j]) for j in range(len(values)) if j != k), default=1.0)
            if len(set(xs)) == 1 and apart > 1e-9 * values[0] and abs(plain) > 1e-6:
                signs.setdefault(k, np.sign(r["whitened"] * plain))
                assert math.isclose(r["whitened"] * signs[k], plain, rel_tol=1e-5, abs_tol=1e-6)


def test_odd_rows(spark):
    rng = np.random.default_rng(1)
    rows = [(n, rng.normal(size=6).astype(np.float32).tolist(), 0) for n in range(200)]
    hot = rng.normal(size=6).astype(np.float32).tolist()
    rows += [(1000 + n, hot, None) for n in range(300)] + [rows[3], rows[3], (None, rows[4][1], 1), (None, rows[4][1], 1)]
    odd = [(1, None, 0), (2, [], 0), (3, [1.0, None, 0.0, 0.0, 0.0, 0.0], 0), (4, [math.nan] * 6, 0), (5, [math.inf, 0.0, 0.0, 0.0, 0.0, 0.0], 0), (6, [1.0, 2.0], 0)]
    frame = spark.createDataFrame(rows + odd, SCHEMA).selectExpr("*", "1 AS x", "2 AS n", "3 AS component", "4 AS dims")
    found = whitening.whitened(frame).collect()
    compare(found, rows)
    assert {r["n"] for r in found} == {201}


def test_entries_far_from_the_origin_lose_nothing(spark):
    """The spread is 14 digits below the entries: a covariance that is not centred first has none of its digits."""
    rng = np.random.default_rng(2)
    rows = [(n, (1e7 + rng.integers(-3, 4, 5) / 64 * [1, 2, 3, 4, 5]).tolist(), 0) for n in range(300)]
    found = whitening.whitened(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")).collect()
    compare(found, rows)


def test_no_spread_gives_no_rows(spark):
    assert whitening.whitened(spark.createDataFrame([], SCHEMA)).collect() == []
    assert whitening.whitened(spark.createDataFrame([(1, None, 0)], SCHEMA)).collect() == []
    assert whitening.whitened(spark.createDataFrame([(n, [1.0, 2.0], 0) for n in range(9)], SCHEMA)).collect() == []


def test_dimensions_without_spread_give_no_components(spark):
    rows = [(n, [float(n % 7), 2.0 * (n % 7), 5.0, float(n % 3)], 0) for n in range(60)]
    found = whitening.whitened(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r["component"] for r in found} == {1, 2}
    compare(found, rows)


def wide_rotation(size, seed):
    q = np.linalg.qr(np.random.default_rng(seed).normal(size=(size, size)))[0].astype(WIDE)
    for _ in range(3):
        q = q + q @ ((np.eye(size) - q.T @ q) / 2)
    return q


@pytest.mark.parametrize(
    "values",
    [
        np.linspace(1, 10, 40),
        np.concatenate([5 + 1e-9 * np.arange(10), [5 + 1e-13], np.linspace(0, 3, 20)]),  # clusters
        np.repeat([3.0, 2.0, 1.0, 0.5], [10, 10, 3, 1]),  # equal ones
        0.5 ** np.arange(60),
        1 + 1e-15 * np.arange(8),
        np.zeros(5),
    ],
)
def test_refinement_reaches_double_precision(values):
    """Float32 vectors have seven digits; the refined ones fit the matrix and each other in all of a double's."""
    rotation = wide_rotation(len(values), 3)
    matrix = (rotation * values.astype(WIDE)) @ rotation.T
    found, vectors = eigen((matrix + matrix.T) / 2)
    scale = np.abs(values).max() or 1
    assert np.abs(matrix @ vectors - vectors * found).max() < 1e-16 * scale
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-16
    assert np.abs(found - np.sort(values)[::-1]).max() < 1e-15 * scale


def test_float32_alone_is_not_enough():
    rotation = wide_rotation(30, 4)
    matrix = (rotation * np.linspace(1, 10, 30)) @ rotation.T
    rough = np.linalg.eigh(matrix.astype(np.float32))[1].astype(WIDE)
    assert np.abs(rough.T @ rough - np.eye(30)).max() > 1e-8


@pytest.mark.parametrize("largest", [3, 1 << 20, 1 << 30, 1 << 39])
def test_products_are_exact(largest):
    rows = np.random.default_rng(5).integers(-largest, largest, (700, 4))
    whole = rows.astype(object)
    assert (products(rows) == whole.T @ whole).all()


def test_deviation_beyond_64_bits_is_null():
    model = whitening.Whitening(10**9, [10**15] * 2, np.ones(1), np.ones((2, 1)), np.ones(1))
    x = np.array([[1_000_000, 1_000_001], [1_000_000, 5_000_000]])
    assert model.deviations(x).tolist() == [10**18, None]


@pytest.mark.parametrize("sf_dir", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query_on_all_vectors(spark, sf_dir):
    rows = [tuple(r) for r in table(spark, sf_dir, "embeddings").collect()]
    compare(QUERIES["op12_embedding_whitening"](spark, sf_dir).collect(), rows)
