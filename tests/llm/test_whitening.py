"""Whitening against numpy's eigenvectors, with exact integers and odd rows."""

import random

import numpy as np
import pytest

from siteloom.llm import queries, whitening

SCHEMA = "vec_id long, embedding array<float>, label int, x int, component string, n long, v int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, "c", 3, 4) for i, v in rows], SCHEMA)


def embeddings(n=300, width=8, seed=4):
    rng = np.random.default_rng(seed)
    rows = rng.normal(size=(n, width)) * np.linspace(3, 0.2, width) + 0.3
    return [(k, [float(np.float32(c)) for c in row]) for k, row in enumerate(rows)]


def brute(rows, top=4):
    """By id: deviation, whitened by component (up to the sign), explained by component, n."""
    kept = [(i, [int(np.floor(256 * float(c))) for c in v]) for i, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    fit = np.array(sorted({tuple(x) for _, x in kept}), object)
    n, sums = len(fit), fit.sum(axis=0)
    centre = np.array([[float(v * n - s) / n for v, s in zip(x, sums, strict=True)] for x in fit])
    values, vectors = np.linalg.eigh(centre.T @ centre / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    made = []
    for i, x in kept:
        y = np.array([float(v * n - s) / n for v, s in zip(x, sums, strict=True)])
        made.append((i, sum((n * v - s) ** 2 for v, s in zip(x, sums, strict=True)), y @ vectors[:, :top] / np.sqrt(values[:top])))
    return n, made, values[:top] / values.sum()


def same(found, rows, top=4):
    n, made, explained = brute(rows, top)
    by = sorted(found, key=lambda r: (r.vec_id is None, r.vec_id or 0, r.deviation, r.component))
    made.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    assert len(by) == len(made) * top
    got = np.array([r.whitened for r in by]).reshape(-1, top)
    want = np.array([w for *_, w in made])
    signs = np.sign((got * want).sum(axis=0))
    assert np.allclose(got * signs, want, atol=1e-9)
    assert [r.deviation for r in by] == [d for _, d, _ in made for _ in range(top)]
    assert {r.n for r in by} == {n}
    assert np.allclose([r.explained for r in by[:top]], explained, rtol=1e-9)
    assert all(r.identity_error < 1e-9 for r in by)


def test_against_eigenvectors(spark):
    rows = embeddings()
    rows += [(1000 + k, rows[7][1]) for k in range(200)]  # copies count once
    same(whitening.whiten(table(spark, rows).repartition(5)).collect(), rows)


def test_odd_rows(spark):
    rows = embeddings(50)
    odd = [(90, None), (91, [1.0] * 7 + [None]), (92, [1.0] * 7 + [float("nan")]), (93, [1.0] * 7 + [float("inf")])]
    more = [(94, [1.0, 2.0]), (95, [])]  # other lengths
    rows += [(None, rows[3][1]), (5, rows[4][1])]
    same(whitening.whiten(table(spark, rows + odd + more)).collect(), rows)


@pytest.mark.parametrize("top", [1, 3, 8])
def test_components(spark, top):
    rows = embeddings(40, 8)
    same(whitening.whiten(table(spark, rows), top).collect(), rows, top)


def test_ill_conditioned(spark):
    rng = random.Random(2)
    rows = []
    for k in range(200):
        a, b = rng.gauss(0, 4000), rng.gauss(0, 0.05)
        rows.append((k, [float(np.float32(v)) for v in (a, a + b, rng.gauss(0, 1), a - b, rng.gauss(0, 0.1), 7.0)]))
    found = whitening.whiten(table(spark, rows)).collect()
    assert len(found) == 800 and all(r.identity_error < 1e-4 for r in found)
    n, made, explained = brute(rows)
    assert np.allclose([r.explained for r in sorted(found, key=lambda r: (r.vec_id, r.component))[:4]], explained, rtol=1e-4)


def test_no_variance_and_empty(spark):
    assert whitening.whiten(table(spark, [])).collect() == []
    assert whitening.whiten(table(spark, [(1, None), (2, [])])).collect() == []
    one = whitening.whiten(table(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect()
    assert [(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in one] == [(1, 0, None, 0.0, None)] * 4
    line = whitening.whiten(table(spark, [(k, [float(k), 2.0 * k, 1.0]) for k in range(5)])).collect()
    assert len(line) == 15
    assert all((r.whitened is None) == (r.component > 1) for r in line)
    assert all(abs(r.explained - (r.component == 1)) < 1e-9 for r in line)


def test_large_numbers(spark):
    rows = [(k, [float(np.float32(3e12 * k)), float(np.float32(k % 3))]) for k in range(6)]
    found = whitening.whiten(table(spark, rows)).collect()
    assert all(r.deviation is None for r in found if r.vec_id != 2 or True)
    assert all(r.identity_error is not None for r in found)
    huge = whitening.whiten(table(spark, [(1, [3e38, 1.0]), (2, [-3e38, 1.0]), (3, [0.0, 2.0])])).collect()
    assert len(huge) == 6 and all(r.n == 3 for r in huge)


def test_query(spark, tmp_path):
    rows = embeddings()
    table(spark, rows).write.parquet(str(tmp_path / "embeddings.parquet"))
    found = queries.QUERIES["op11_whitening"](spark, str(tmp_path))
    kinds = ["bigint", "int", "bigint", "bigint", "double", "double", "double"]
    assert [t for _, t in found.dtypes] == kinds
    same(found.collect(), rows)
