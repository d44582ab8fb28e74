"""Whitening: the solver against numpy, the operator against brute force, edges."""

import numpy as np
import pytest

from lapse.llm import bidiagonal, whitening


def orthogonal(rng, n):
    return np.linalg.qr(rng.normal(size=(n, n)))[0]


def spectra():
    rng = np.random.default_rng(0)
    return {"random": rng.random(64), "graded": 10.0 ** -np.arange(64) / 4, "equal": np.ones(64), "pairs": np.repeat([3.0, 2, 1], [2, 2, 60]),
            "cluster": np.r_[np.ones(5), 1 + 1e-9 * np.arange(5), rng.random(54)], "near": 1 + 1e-12 * rng.random(64),
            "nearer": 1 + 1e-5 * rng.random(64), "rank": np.r_[3.0, 2, 2, np.zeros(61)], "one": np.r_[1.0, np.zeros(63)], "none": np.zeros(64)}


@pytest.mark.parametrize("name", spectra())
@pytest.mark.parametrize("form", ["full", "triangular", "diagonal"])
def test_directions(name, form):
    rng, s = np.random.default_rng(1), spectra()[name]
    a = np.diag(s) if form == "diagonal" else orthogonal(rng, 64) @ np.diag(s) @ orthogonal(rng, 64).T
    a = np.linalg.qr(a)[1] if form == "triangular" else a
    values, vectors = bidiagonal.directions(a, 4)
    real = np.sort(s)[::-1][:4] ** 2
    assert len(values) == (real > 0).sum() if name != "graded" else 4
    if len(values):
        assert np.abs(values - real[:len(values)]).max() < 1e-13 * real[0]
        assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-12
        assert np.abs(a.T @ (a @ vectors) - vectors * values).max() < 1e-13 * real[0]


@pytest.mark.parametrize("n", [1, 2, 3, 7, 130])
def test_all_values(n):
    a = np.random.default_rng(n).normal(size=(n, n))
    diagonal, above, v = bidiagonal.bidiagonalise(a)
    assert np.abs(v.T @ v - np.eye(n)).max() < 1e-13
    got = bidiagonal.qd_eigenvalues(diagonal, above)
    assert np.allclose(got, np.linalg.svd(a, compute_uv=False) ** 2, rtol=1e-12, atol=1e-12 * got[0])


def test_small_values_keep_relative_accuracy():
    """A graded bidiagonal matrix: its least value is the product of the diagonal over the others, not noise."""
    diagonal = 10.0 ** -np.arange(12)
    above = 0.5 * diagonal[:-1]
    got = bidiagonal.qd_eigenvalues(diagonal, above)
    assert abs(np.sqrt(np.prod(got / diagonal ** 2)) - 1) < 1e-13


def plain(rows, k=4):
    """{(vec_id, component): values} by the covariance's eigenvectors."""
    kept = [(i, [int(np.floor(256 * float(np.float32(c)))) for c in v]) for i, v in rows
            if v and all(c is not None and np.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in kept})
    n, total = len(fit), [sum(c) for c in zip(*fit)]
    f = (n * np.array(fit) - np.array(total)) / n
    cov = f.T @ f / n
    e, w = np.linalg.eigh(cov)
    e, w = e[::-1][:k], w[:, ::-1][:, :k]
    out = []
    for i, x in kept:
        d = [n * a - s for a, s in zip(x, total)]
        for j in range(k):
            out.append((i, j + 1, n, sum(a * a for a in d), (np.array(d) / n) @ w[:, j] / np.sqrt(e[j]), e[j] / np.trace(cov)))
    return out


def run(spark, tmp_path, rows, parts=5):
    import pyspark.sql.functions as F
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("x", F.lit("clash")).repartition(parts)
    df.write.mode("overwrite").parquet(f"{tmp_path}/embeddings.parquet")
    return whitening.op12_whitening(spark, str(tmp_path)).collect()


def check(got, want):
    assert len(got) == len(want)
    sign = {}
    key = lambda r: (r[1], str(r[0]), r[3], abs(r[4]))
    for g, w in zip(sorted(map(tuple, got), key=key), sorted(want, key=key)):
        assert g[:4] == w[:4]
        assert abs(abs(g[4]) - abs(w[4])) < 1e-8 * (1 + abs(w[4])) and abs(g[5] - w[5]) < 1e-10
        if abs(w[4]) > 1e-6:
            assert sign.setdefault(g[1], g[4] * w[4] > 0) == (g[4] * w[4] > 0)
        assert g[6] <= 1e-9


@pytest.mark.parametrize("fan_in, block", [(32, 2048), (2, 7)])
def test_against_brute_force(spark, tmp_path, monkeypatch, fan_in, block):
    monkeypatch.setattr(whitening, "FAN_IN", fan_in)
    monkeypatch.setattr(whitening, "BLOCK", block)
    rng = np.random.default_rng(2)
    base = (rng.normal(size=(300, 12)) * np.r_[5, 4, 3, 2, np.ones(8)] @ orthogonal(rng, 12) / 9).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(base)]
    rows += [(1000 + i, base[0].tolist()) for i in range(200)] + [(3, base[3].tolist()), (None, base[4].tolist())]
    bad = [(900, None), (901, []), (902, [None] * 12), (903, [float("nan")] * 12), (904, [float("inf")] + [0.0] * 11)]
    check(run(spark, tmp_path, rows + bad, 11), plain(rows))


def test_fewer_components(spark, tmp_path):
    rows = [(i, [float(i % 3), 1.0, 2.0]) for i in range(9)]
    got = run(spark, tmp_path, rows)
    assert {r["component"] for r in got} == {1} and len(got) == 9
    assert {r["n"] for r in got} == {3} and all(abs(r["explained"] - 1) < 1e-12 for r in got)
    assert run(spark, tmp_path, [(1, [1.0, 2.0]), (2, [1.0, 2.0])]) == []
    assert run(spark, tmp_path, []) == [] and run(spark, tmp_path, [(1, None)]) == []


def test_lengths_and_large_entries(spark, tmp_path):
    rows = [(i, [float(i), float(i * i), 1.0]) for i in range(6)]
    got = run(spark, tmp_path, rows + [(50, [1.0]), (51, [2.0, 3.0])])
    assert {r["vec_id"] for r in got} == set(range(6))
    huge = run(spark, tmp_path, [(1, [1e30, 0.0]), (2, [-1e30, 0.0]), (3, [0.0, 4.0])])
    assert {r["component"] for r in huge} == {1} and len(huge) == 3      # the other is under the first's rounding
    assert all(r["deviation"] is None for r in huge if r["vec_id"] < 3)


def test_table(spark, sf_dir):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    check(whitening.op12_whitening(spark, sf_dir).collect(), plain(rows))
