"""Near-duplicate vectors by a pivot-permutation index (Amato and Savino, 2008).

A vector is described by the ordered list of its nearest reference points (pivots). Vectors
that are close order the pivots alike, so they share pivots at the head of their lists.
Inverted lists (pivot -> vectors with it in their head) bring vectors together; pairs that
share enough pivots are verified by cosine in double precision.

Layout: pivots are a bounded sample of the distinct vectors (`N_PIVOTS`, the only thing that
is sent to every task); every vector is indexed. Where one group of near copies would fill its
members' lists with pivots of its own, whose order among close vectors is chance, pivots are
thinned until the sample's own links share enough of them (`RECALL`): the group then shares
its few pivots and is told apart by those outside. A table that is one such group keeps few
pivots and long lists; if no thinning finds that share of the sample's links, one pivot is
left, whose list has all vectors, and all pairs are compared. Vectors of different width are
indexed apart, any number of widths, `WIDTHS` of them in one pass. Equal vectors are one class and are
counted, never paired. An inverted list too long for one task is cut into blocks, and pairs of blocks
are the units of work. A pair of vectors is looked at in the list of its lowest shared pivot
only. Units give the number of links of each vector and a spanning forest of the links.

Edge cases: a vector that is null, empty, zero or holds a null or non-finite component links
with nothing and is its own component. Vectors of different length do not link. Rows that
repeat an id count as vectors of their own with that id. A null id is returned with a null
component. Further columns are ignored. An empty table gives an empty result.
"""

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from postlake.llm.arrays import by_width
from postlake.llm.graph import connected_components, local_roots
from postlake.session import stage

#: Sample size of reference points; bounds what every task carries.
N_PIVOTS = 256
#: Length of the head of each ordered list, and pivots that a pair must share.
HEAD = 10
SHARED = 2
#: Vectors read to choose pivots from, the share of their links that must be found with the
#: pivots chosen, and the bounds tried for the cosine of two pivots, in steps of 1 - cosine.
CANDIDATES = 1_024
RECALL = 0.99
THINNINGS = 6
BLOCK = 2_048
WORDS = N_PIVOTS // 64
#: Widths indexed in one pass: bounds the pivots sent to every task and the samples read.
WIDTHS = 32

VECTORS = "vec_id bigint, digest binary, embedding array<double>"


def _digests(batches):
    """Vectors in double with a digest of their components."""
    for batch in batches:
        for _, places, rows in by_width(batch, "embedding"):
            rows = rows + 0.0
            digests = [hashlib.blake2b(row, digest_size=16).digest() for row in rows]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(places)), pa.array(digests, pa.binary()), _lists(rows)], names=["vec_id", "digest", "embedding"]
            )


def _lists(rows: np.ndarray) -> pa.Array:
    ends = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.ascontiguousarray(rows).ravel()))


def unit_rows(vectors) -> np.ndarray:
    rows = np.stack(vectors).astype(np.float64, copy=False)
    rows = rows / np.abs(rows).max(axis=1)[:, None]
    return rows / np.sqrt((rows * rows).sum(axis=1))[:, None]


def _heads(pivots: dict):
    """Adds each vector's width and its ordered nearest pivots among those of its width."""

    def run(batches):
        for batch in batches:
            for width, places, rows in by_width(batch, "embedding"):
                for at in range(0, len(rows), 2_000):
                    some = rows[at : at + 2_000]
                    near = np.argsort(-(unit_rows(some) @ pivots[width].T), axis=1, kind="stable")[:, :HEAD].astype(np.int32)
                    part = batch.take(pa.array(places[at : at + 2_000]))
                    yield pa.RecordBatch.from_arrays(
                        [*part.columns, pa.array([width] * len(some), pa.int32()), _lists(near)], names=[*part.schema.names, "width", "head"]
                    )

    return run


def _bits(heads) -> np.ndarray:
    """Head lists of one length as bit sets, one row of 64-bit words each."""
    heads = np.stack(heads)
    out = np.zeros((len(heads), WORDS), np.uint64)
    rows = np.repeat(np.arange(len(heads)), heads.shape[1])
    np.bitwise_or.at(out, (rows, heads.ravel() // 64), np.uint64(1) << (heads.ravel() % 64).astype(np.uint64))
    return out


def _search(cosine: float):
    def run(unit: pd.DataFrame) -> pd.DataFrame:
        # With fewer pivots than a pair must share, all that there are.
        least = min(SHARED, int(unit["n_pivots"].iloc[0]))
        pivot = int(unit["pivot"].iloc[0])
        ids, copies = unit["vec_id"].to_numpy(), unit["copies"].to_numpy()
        side = unit["side"].to_numpy()
        rows, bits = unit_rows(unit["embedding"]), _bits(unit["head"])
        lower = bits.copy()
        lower[:, pivot // 64] &= (np.uint64(1) << np.uint64(pivot % 64)) - np.uint64(1)
        lower[:, pivot // 64 + 1 :] = 0
        crossed = bool(side.any())
        left = np.flatnonzero(side == 0)
        right = np.flatnonzero(side == 1) if crossed else left
        a, b, degree = [], [], np.zeros(len(ids), np.int64)
        for at in range(0, len(left), 256):
            some = left[at : at + 256]
            shared = np.zeros((len(some), len(right)), np.int64)
            first = np.ones((len(some), len(right)), bool)
            for word in range(WORDS):
                shared += np.bitwise_count(bits[some, word][:, None] & bits[right, word])
                first &= (lower[some, word][:, None] & lower[right, word]) == 0
            asked = first & (shared >= least)
            if not crossed:
                asked &= some[:, None] < right
            x, y = np.flatnonzero(asked.any(axis=1)), np.flatnonzero(asked.any(axis=0))
            if not len(x):
                continue
            near = (rows[some[x]] @ rows[right[y]].T >= cosine) & asked[np.ix_(x, y)]
            i, j = np.nonzero(near)
            i, j = some[x[i]], right[y[j]]
            if len(i):
                np.add.at(degree, i, copies[j])
                np.add.at(degree, j, copies[i])
                nodes, roots = local_roots(ids[i], ids[j])
                a.append(nodes)
                b.append(roots)
        if not a:
            return pd.DataFrame({"a": [], "b": [], "n_links": []}).astype("int64")
        nodes, roots = local_roots(np.concatenate(a), np.concatenate(b))
        linked = degree > 0
        return pd.concat([
            pd.DataFrame({"a": nodes, "b": roots, "n_links": np.int64(0)}),
            pd.DataFrame({"a": ids[linked], "b": ids[linked], "n_links": degree[linked]}),
        ])

    return run


def _thinned(sample: np.ndarray, bound: float) -> np.ndarray:
    """The first N_PIVOTS vectors of the sample of which no two reach the bound."""
    kept, free = [], np.ones(len(sample), bool)
    for i in range(len(sample)):
        if free[i] and len(kept) < N_PIVOTS:
            kept.append(i)
            free &= sample @ sample[i] < bound
    return sample[kept]


def _sample_links(sample: np.ndarray, cosine: float) -> list:
    """Pairs to try pivots on, each as two tables of vectors and two arrays of places: the links
    within the sample, and its vectors turned to the bound towards random mixtures of it."""
    i, j = np.nonzero(np.triu(sample @ sample.T >= cosine, 1))
    out = [(sample, sample, i, j)] if len(i) else []
    mixed = np.random.default_rng(7).normal(size=(len(sample), len(sample))) @ sample
    mixed -= (mixed * sample).sum(axis=1)[:, None] * sample
    length = np.sqrt((mixed * mixed).sum(axis=1))
    own = sample[length > 1e-6]
    if len(own):
        turned = cosine * own + np.sqrt(max(0.0, 1 - cosine * cosine)) * mixed[length > 1e-6] / length[length > 1e-6][:, None]
        out.append((own, turned, np.arange(len(own)), np.arange(len(own))))
    return out


def _recall(pivots: np.ndarray, links: list) -> float:
    """The share of links that have enough pivots in common, of the kind that has least."""
    def marks(rows):
        out = np.zeros((len(rows), len(pivots)), np.float32)
        np.put_along_axis(out, np.argsort(-(rows @ pivots.T), axis=1, kind="stable")[:, :HEAD], 1, axis=1)
        return out

    return min(((marks(a) @ marks(b).T)[i, j] >= min(SHARED, len(pivots))).mean() for a, b, i, j in links) if links else 1.0


def spread_pivots(sample: np.ndarray, cosine: float) -> np.ndarray:
    """The most pivots of the sample with which its links are found. If none will do, a single
    one: its list holds every vector, so all pairs are compared."""
    links = _sample_links(sample, cosine)
    for step in range(THINNINGS + 1):
        # The first does not thin.
        pivots = _thinned(sample, 1 - step * (1 - cosine)) if step else sample[:N_PIVOTS]
        if _recall(pivots, links) >= RECALL:
            return pivots
    return sample[:1]


def choose_pivots(classes: DataFrame, counts: dict, cosine: float) -> dict:
    """Pivots by width, at most N_PIVOTS each, from a sample of about CANDIDATES vectors of each
    width in `counts`, drawn by a hash of the id."""
    parts = classes.sparkSession.createDataFrame(
        [(w, min(1.0, CANDIDATES / n)) for w, n in counts.items()], "width int, part double"
    )
    place = F.pmod(F.xxhash64("vec_id", F.lit("pivots")), F.lit(1 << 30)) / float(1 << 30)
    drawn = classes.join(F.broadcast(parts), F.size("embedding") == F.col("width")).where(place < F.col("part"))
    sample: dict = {}
    for row in drawn.select("width", "vec_id", "embedding").orderBy("width", F.xxhash64("vec_id"), "vec_id").limit(2 * CANDIDATES * WIDTHS).toLocalIterator():
        sample.setdefault(row.width, []).append(np.array(row.embedding))
    # A width of which nothing was drawn has few vectors: any direction will do as its only pivot.
    return {w: spread_pivots(unit_rows(sample[w][:CANDIDATES]), cosine) if w in sample else np.eye(1, w) for w in counts}


def pivot_links(classes: DataFrame, cosine: float) -> DataFrame:
    """(a, b, n_links): forest links between classes (vec_id, copies, embedding), and at a = b
    the number of vectors in other classes linked with a class."""
    counts = dict(classes.groupBy(F.size("embedding")).count().orderBy("count").collect())
    found, widths = None, sorted(counts)
    for first in range(0, len(widths), WIDTHS):
        some = widths[first : first + WIDTHS]
        own = classes.where(F.size("embedding").between(some[0], some[-1]))
        pivots = choose_pivots(own, {w: counts[w] for w in some}, cosine)
        described = stage(own.mapInArrow(
            _heads(pivots), "vec_id bigint, copies bigint, embedding array<double>, width int, head array<int>"
        ), "heads")
        listed = described.select("*", F.explode("head").alias("pivot"))
        # One row per width and pivot: bounded by WIDTHS * N_PIVOTS whatever the data.
        sizes = listed.groupBy("width", "pivot").agg(F.ceil(F.count("*") / F.lit(BLOCK)).cast("bigint").alias("parts"))
        numbers = own.sparkSession.createDataFrame([(w, len(p)) for w, p in pivots.items()], "width int, n_pivots int")
        placed = listed.join(F.broadcast(sizes.join(F.broadcast(numbers), "width")), ["width", "pivot"]).withColumn(
            "part", F.pmod(F.xxhash64("vec_id"), F.col("parts"))
        )
        units = placed.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1))).select(
            "width", "pivot", "n_pivots", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"),
            F.when(F.col("part") > F.col("other"), 1).otherwise(0).alias("side"),
            "vec_id", "copies", "embedding", "head",
        )
        part = units.groupBy("width", "pivot", "low", "high").applyInPandas(_search(cosine), "a bigint, b bigint, n_links bigint")
        found = part if found is None else found.union(part)
    return found


def near_vectors(vectors: DataFrame, cosine: float = 0.95) -> DataFrame:
    """(vec_id, n_links, component_id, kept) per row of vectors (vec_id, embedding)."""
    rows = vectors.select(F.col("vec_id").cast("bigint"), "embedding")
    usable = stage(
        rows.where(_has_direction()).select("vec_id", F.col("embedding").cast("array<double>")).mapInArrow(_digests, VECTORS), "vectors"
    )
    classes = stage(
        usable.groupBy("digest").agg(
            F.min("vec_id").alias("vec_id"), F.count("*").alias("copies"), F.first("embedding").alias("embedding")
        ),
        "classes",
    )
    named = classes.where("vec_id is not null").select("vec_id", "copies", "embedding")
    links = pivot_links(named, cosine)
    out = usable.select("vec_id", "digest").join(classes.drop("embedding").withColumnRenamed("vec_id", "first_id"), "digest")
    if links is None:
        out = out.select("vec_id", "copies", "first_id", F.lit(None).cast("bigint").alias("component"),
                         F.lit(0).cast("bigint").alias("linked"))
    else:
        links = stage(links, "links")
        components = connected_components(links.select("a", "b"))
        degrees = links.where("n_links > 0").groupBy(F.col("a").alias("first_id")).agg(F.sum("n_links").alias("linked"))
        out = out.join(components.withColumnRenamed("node", "first_id"), "first_id", "left").join(degrees, "first_id", "left")
    found = out.select(
        "vec_id", (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).cast("bigint").alias("n_links"),
        F.coalesce("component", "first_id").alias("component_id"),
    )
    # Vectors without a direction are the rest; they carry no digest.
    rest = rows.where(~_has_direction()).select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    both = found.union(rest)
    return both.select(
        "vec_id", "n_links", F.when(F.col("vec_id").isNotNull(), F.col("component_id")).alias("component_id"),
        (F.col("vec_id") == F.col("component_id")).alias("kept"),
    )


def _has_direction():
    e = F.col("embedding")
    finite = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return F.coalesce(F.size(e) > 0, F.lit(False)) & F.coalesce(finite, F.lit(False)) & F.coalesce(
        F.exists(e, lambda x: x != 0), F.lit(False)
    )
