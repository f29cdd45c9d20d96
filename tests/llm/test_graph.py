import numpy as np

from postlake.llm.graph import connected_components, local_roots


def test_chain_star_and_repeats(spark):
    links = [(i, i + 1) for i in range(1, 60)] + [(100, i) for i in range(101, 150)] + [(7, 7), (200, 201), (201, 200), (None, 3)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long").repartition(5)).collect()}
    assert got == {i: 1 for i in range(1, 61)} | {i: 100 for i in range(100, 150)} | {200: 200, 201: 200}


def test_no_links(spark):
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_local_roots_of_random_links():
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 300, 200), rng.integers(0, 300, 200)
    nodes, roots = local_roots(a, b)
    root = dict(zip(nodes, roots))
    assert all(root[x] == root[y] for x, y in zip(a, b)) and all(root[r] == r and r <= n for n, r in root.items())
