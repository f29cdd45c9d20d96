"""Connected components of links, without gathering a component anywhere.

Links are first contracted inside each partition (a forest has fewer links than nodes and
points to its least node, so nodes at the far end of many links are no hot keys), then
large-star and small-star steps (Kiveris et al., 2014) alternate until nothing changes. Each
step is an aggregation for the least neighbour and a join with it. Links always point from
the greater id to the lesser, so a node that very many link with is a hot key of one join
only, whose sides are plain tables that Spark splits where they are skewed. Every step is written to the shared folder: lost executors
lose nothing, and plans stay short.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from postlake.session import stage

LINKS = "a bigint, b bigint"
CHUNK_LINKS = 500_000


def local_roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, least node each can reach) over links given as two arrays of ids."""
    nodes, places = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = places[: len(a)], places[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[u], root[v])
        new = root.copy()
        np.minimum.at(new, root[u], low)
        np.minimum.at(new, root[v], low)
        while True:
            jumped = new[new]
            if np.array_equal(jumped, new):
                break
            new = jumped
        if np.array_equal(new, root):
            return nodes, nodes[root]
        root = new


def _contract(batches):
    held, size = [], 0
    fields = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def forest():
        nodes, roots = local_roots(
            np.concatenate([x for x, _ in held]), np.concatenate([y for _, y in held])
        )
        keep = nodes != roots
        return nodes[keep], roots[keep]

    for batch in batches:
        held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy()))
        size += batch.num_rows
        if size > CHUNK_LINKS:
            held = [forest()]
            size = 0
    if held:
        a, b = forest()
        for at in range(0, len(a), 50_000):
            yield pa.RecordBatch.from_arrays([pa.array(a[at : at + 50_000]), pa.array(b[at : at + 50_000])], schema=fields)


def _mark(links: DataFrame):
    row = links.agg(
        F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    ).first()
    return tuple(row)


def connected_components(links: DataFrame, name="components") -> DataFrame:
    """(node, component): the least node reachable, for every node of a link (a, b).

    Links of a node with itself and null ends are ignored; repeated links do no harm.
    """
    links = links.select(F.col("a").cast("bigint"), F.col("b").cast("bigint")).where("a <> b")
    # Once where the links are, once where all links of a node are: few are left of many.
    near = links.mapInArrow(_contract, LINKS)
    links = stage(near.repartition("a").mapInArrow(_contract, LINKS), name)
    mark = _mark(links)
    while mark[0]:
        # Large star: what points to b points to b's least neighbour instead. A node that
        # nothing precedes has no row in `low`; written first, the join's hot side can split.
        low = stage(links.groupBy("a").agg(F.min("b").alias("low")), name)
        large = links.join(low.select(F.col("a").alias("b"), "low"), "b", "left").select(
            "a", F.coalesce("low", "b").alias("b")
        ).distinct()
        # Small star: a and all it points to point to the least of them.
        least = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(least, "a").select(F.explode(F.array(
            F.struct("a", F.col("low").alias("b")), F.struct(F.col("b").alias("a"), F.col("low").alias("b"))
        )).alias("x")).select("x.a", "x.b").where("a <> b").distinct()
        links = stage(small, name)
        new = _mark(links)
        if new == mark:
            break
        mark = new
    heads = links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).union(heads)
