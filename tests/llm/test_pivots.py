import numpy as np
import pytest

from postlake.llm import pivots as V

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, cosine):
    units = []
    for _, v in rows:
        ok = v is not None and len(v) and None not in v and np.isfinite(v).all() and np.any(v)
        units.append(np.asarray(v, float) / np.linalg.norm(np.asarray(v, float) / np.abs(v).max()) / np.abs(v).max() if ok else None)
    links = [[j for j in range(len(rows)) if j != i and units[i] is not None and units[j] is not None
              and len(units[i]) == len(units[j]) and units[i] @ units[j] >= cosine] for i in range(len(rows))]
    out = []
    for i, (vec_id, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        least = min(ids) if vec_id is not None else None
        out.append((vec_id, len(links[i]), least, None if vec_id is None else vec_id == least))
    return sorted(out, key=repr)


def run(spark, rows, **how):
    frame = spark.createDataFrame([(i, v, 1) for i, v in rows], SCHEMA)
    return sorted((tuple(r) for r in V.near_vectors(frame, **how).collect()), key=repr)


def test_hard_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (5, [1.0, 0.0, 0.0]), (3, [2.0, 0.0, 0.0]), (9, [1.0, 0.1, 0.0]), (9, [1.0, 0.1, 0.0]), (4, [0.0, 1.0, 0.0]),
        (6, [-1.0, 0.0, 0.0]), (7, None), (8, []), (10, [0.0, 0.0, 0.0]), (11, [1.0, None, 0.0]), (12, [nan, 1.0, 0.0]),
        (13, [inf, 1.0, 0.0]), (14, [1.0, 0.0]), (15, [1e300, 1e300]), (16, [1e-300, 1e-300]), (None, [0.0, 0.0, 1.0]),
    ]
    assert run(spark, rows) == brute(rows, 0.95)


def test_recall_and_blocks(spark, monkeypatch):
    """Clusters around the bound, a large group of copies, lists cut into blocks."""
    monkeypatch.setattr(V, "BLOCK", 50)
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(30, 32))
    rows = [(i, (centres[i % 30] + rng.normal(size=32) * rng.choice([0.05, 0.2, 0.3])).tolist()) for i in range(500)]
    rows += [(1000 + i, rows[3][1]) for i in range(80)]
    got, want = run(spark, rows), brute(rows, 0.95)
    found, there = sum(r[1] for r in got), sum(r[1] for r in want)
    assert there > 1000 and found >= 0.98 * there
    assert all(a[1] <= b[1] for a, b in zip(got, want))


@pytest.mark.parametrize("share", [0.33, 1.0])
def test_recall_of_a_hot_group(spark, share):
    """A large share of the rows are distinct near copies of one vector."""
    rng = np.random.default_rng(4)
    vectors = rng.normal(size=(1500, 64)) / 8
    hot = int(1500 * share)
    vectors[:hot] = np.sqrt(0.97) * vectors[0] / np.linalg.norm(vectors[0]) + np.sqrt(0.03) * vectors[:hot]
    units = vectors / np.linalg.norm(vectors, axis=1)[:, None]
    there = int((units @ units.T >= 0.95).sum()) - len(units)
    found = sum(r[1] for r in run(spark, list(enumerate(vectors.tolist()))))
    assert 0.98 * there <= found <= there and there > 100_000


@pytest.mark.parametrize("rows", [[], [(1, None)]])
def test_nothing_usable(spark, rows):
    assert run(spark, rows) == [(i, 0, i, True) for i, _ in rows]


def test_many_widths(spark, monkeypatch):
    """Each width has a linked pair, over more widths than one pass takes."""
    monkeypatch.setattr(V, "WIDTHS", 3)
    rng = np.random.default_rng(6)
    rows = []
    for width in range(2, 12):
        v = rng.normal(size=width)
        rows += [(10 * width, v.tolist()), (10 * width + 1, (v * 1.5 + 0.01).tolist()), (10 * width + 2, (-v).tolist())]
    got = run(spark, rows)
    assert got == brute(rows, 0.95) and sum(r[1] for r in got) == 20


def test_no_pivots_good_enough(spark, monkeypatch):
    """If the sample's links are not found with any thinning, all pairs are compared."""
    monkeypatch.setattr(V, "RECALL", 1.1)
    rng = np.random.default_rng(9)
    rows = [(i, (rng.normal(size=8) * 0.3 + np.eye(8)[i % 4]).tolist()) for i in range(300)]
    assert run(spark, rows) == brute(rows, 0.95)
