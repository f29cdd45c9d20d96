import math

import numpy as np
import pytest

from postlake.llm import bidiagonal as B, queries as Q, whitening as W

SCHEMA = "vec_id long, embedding array<double>, label int"


@pytest.mark.parametrize("n", [1, 2, 3, 17, 64])
def test_components_equal_those_of_svd(n):
    rng = np.random.default_rng(n)
    r = rng.normal(size=(n, n)) * np.logspace(0, 3, n)
    values, rows = B.leading_components(r, 4)
    _, s, vt = np.linalg.svd(r)
    assert np.allclose(values, s * s, rtol=1e-12)
    assert np.allclose(np.abs((rows * vt[: len(rows)]).sum(axis=1)), 1, atol=1e-12)
    assert np.allclose(rows @ rows.T, np.eye(len(rows)), atol=1e-12)


def test_least_values_are_accurate_relatively():
    rng = np.random.default_rng(8)
    for _ in range(20):
        a, b = 10.0 ** rng.uniform(-12, 3, 40), 10.0 ** rng.uniform(-12, 3, 39)
        values = B.dqds(a, b)
        assert math.isclose(np.log(values).sum(), 2 * np.log(a).sum(), rel_tol=1e-12)
        assert (np.diff(values) <= 0).all() and (values > 0).all()


def test_tied_and_missing_values():
    for values in ([3, 3, 3, 3, 3, 1], [5, 5, 2, 2, 0, 0], [1, 0, 0, 0, 0, 0], [0] * 6, [2, 2, 2, 2, 2, 2]):
        q, p = (np.linalg.qr(np.random.default_rng(i).normal(size=(6, 6)))[0] for i in (1, 2))
        r = q @ np.diag(np.array(values, float)) @ p.T
        got, rows = B.leading_components(r, 4)
        assert np.allclose(got, np.square(values), atol=1e-12)
        live = rows[: min(4, np.count_nonzero(values))]
        assert np.allclose(live @ live.T, np.eye(len(live)), atol=1e-10)
        assert np.allclose(live @ (r.T @ r), got[: len(live), None] * live, atol=1e-10)


def brute(rows):
    """vec_id, component -> (n, deviation, |whitened|, explained) of rows of one width."""
    kept = [(i, [math.floor(256 * float(c)) for c in v]) for i, v in rows]
    x = np.array(sorted({tuple(v) for _, v in kept}), float)
    n, sums = len(x), [int(s) for s in x.sum(axis=0)]
    values, vectors = np.linalg.eigh(np.cov(x.T, bias=True).reshape(len(sums), len(sums)))
    out = []
    for i, v in kept:
        deviation = sum((n * a - s) ** 2 for a, s in zip(v, sums))
        for c in range(min(4, len(sums))):
            e = values[-1 - c]
            w = abs((np.array(v) - np.array(sums) / n) @ vectors[:, -1 - c]) / np.sqrt(e) if e > 1e-9 else None
            out.append((i, c + 1, n, deviation, w, max(e, 0) / max(values.sum(), 1e-300)))
    return out


def check(got, want):
    assert len(got) == len(want)
    for g, w in zip(sorted(got, key=lambda r: (repr(r.vec_id), r.component, r.deviation)), sorted(want, key=lambda r: (repr(r[0]), r[1], r[3]))):
        assert (g.vec_id, g.component, g.n, g.deviation) == w[:4]
        assert (g.whitened is None) == (w[4] is None) and (w[4] is None or math.isclose(abs(g.whitened), w[4], abs_tol=1e-7))
        assert math.isclose(g.explained, w[5], abs_tol=1e-9) and g.identity_error < 1e-9


def run(spark, rows, path):
    spark.createDataFrame([(i, v, 1) for i, v in rows], SCHEMA).write.parquet(f"{path}/embeddings.parquet")
    return Q.op11_embedding_whitening(spark, str(path)).collect()


def test_query_equals_brute_force(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()]
    got = Q.op11_embedding_whitening(spark, "/root/testdata/sf0.001").collect()
    check(got, brute(rows))
    assert len({r.identity_error for r in got}) == 1
    signs = {}
    for r in got:
        signs.setdefault(r.component, []).append(r.whitened)
    x = np.array([signs[c] for c in (1, 2, 3, 4)])
    assert x.shape == (4, len(rows))


def test_many_parts_and_merges(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(W, "TRIANGLE_BYTES", 1)
    monkeypatch.setattr(W, "ROWS", 7)
    rng = np.random.default_rng(1)
    rows = [(i, (rng.normal(size=9) + 40).tolist()) for i in range(300)]
    check(run(spark, rows + rows[:50], tmp_path), brute(rows + rows[:50]))


def test_hard_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(W, "WIDTHS", 2)
    nan, inf = float("nan"), float("inf")
    gone = [(1, None), (2, []), (3, [1.0, None]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [1.0, -inf])]
    two = [(7, [0.0, 1.0]), (8, [-0.0, 1.0]), (9, [0.5, -0.3]), (None, [0.25, 0.7]), (7, [0.0, 1.0])]
    one, three, five = [(10, [3.0]), (11, [4.0])], [(12, [1.0, 2.0, 3.0])], [(20 + i, [1.0, i / 2, 1.0, 2.0 * i, 0.0]) for i in range(5)]
    got = run(spark, gone + two + one + three + five, tmp_path)
    want = brute(two) + brute(one) + [(12, c, 1, 0, None, 0) for c in (1, 2, 3)] + brute(five)
    check(got, want)


def test_deviation_beyond_64_bits_and_empty(spark, tmp_path):
    rows = run(spark, [(1, [1e300, 0.0]), (2, [-1e300, 1.0]), (3, [0.0, 2.0])], tmp_path / "a")
    assert len(rows) == 6 and {r.deviation for r in rows if r.vec_id in (1, 2)} == {None}
    assert run(spark, [(1, None)], tmp_path / "b") == []
