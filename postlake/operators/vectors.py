"""Exact nearest posts by cosine similarity. Vectors are given, never computed here.

Each task scores its own vectors against all queries as one matrix product and, for a
top-n, passes on only its own best n per query.
"""

import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window, functions as F

from postlake.operators.ranking import topk
from postlake.session import stage

# The scoring code travels with the tasks, so executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SCORES = "query_id string, post_id string, score double"
SCORE_FIELDS = [("query_id", pa.string()), ("post_id", pa.string()), ("score", pa.float64())]

# Query tables up to this many rows and bytes travel with the tasks; larger ones are cut into
# blocks of this size and joined.
MAX_CARRIED_QUERIES = 4_096
MAX_CARRIED_BYTES = 16_000_000

# Scores worked on at a time by a task, in double (some 16 MB, and a few copies of it).
SCORES_AT_A_TIME = 2_000_000

# Vectors a task scores at a time, about, and per group on the joined path.
TABLE_BYTES = 16_000_000
SHARD_ROWS = 50_000


def _unit_matrix(vectors: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(rows scaled to length 1 in double, which rows have a direction at all)."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    sizes = pc.list_value_length(vectors)
    usable = pc.fill_null(pc.greater(sizes, 0), False)
    width = pc.max(sizes).as_py() or 1
    kept = vectors.filter(usable)
    if pc.any(pc.not_equal(pc.list_value_length(kept), width)).as_py():
        raise ValueError("vectors differ in length")
    rows = kept.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)
    lengths = np.linalg.norm(rows, axis=1)
    has_direction = lengths > 0
    mask = np.asarray(usable.to_numpy(zero_copy_only=False), dtype=bool)
    mask[np.flatnonzero(mask)[~has_direction]] = False
    return rows[has_direction] / lengths[has_direction, None], mask


def _unit_tables(tables):
    """(unit rows, their ids) of tables of any size, regrouped to TABLE_BYTES or so each."""

    def rows_of(waiting):
        table = pa.concat_tables(waiting)
        rows, mask = _unit_matrix(table["embedding"])
        return rows, table["post_id"].to_numpy(zero_copy_only=False)[mask].astype(str)

    waiting, size = [], 0
    for table in tables:
        step = max(1, TABLE_BYTES * table.num_rows // max(1, table.nbytes))
        for at in range(0, table.num_rows, step):
            part = table.slice(at, step)
            waiting, size = [*waiting, part], size + part.nbytes
            if size >= TABLE_BYTES:
                yield rows_of(waiting)
                waiting, size = [], 0
    if waiting:
        yield rows_of(waiting)


def _score_blocks(query_rows: np.ndarray, rows: np.ndarray):
    """(number of the first query, scores of some queries against all rows), block by block."""
    step = max(1, SCORES_AT_A_TIME // max(1, len(rows)))
    for at in range(0, len(query_rows), step):
        yield at, np.round(query_rows[at : at + step] @ rows.T, 6) + 0.0


class _Best:
    """The n best hits of every query so far: those above its n-th score and, by id, of those
    that share it. What waits to be cut is bounded."""

    def __init__(self, n_queries: int, n: int):
        self.n = n
        # The n best scores of each query, the least of them first.
        self.top = np.full((n_queries, n), -np.inf)
        self.hits, self.waiting = [], 0

    def add(self, at: int, scores: np.ndarray, ids: np.ndarray) -> None:
        width = scores.shape[1]
        both = np.concatenate([self.top[at : at + len(scores)], scores], axis=1)
        both.partition(width, axis=1)
        self.top[at : at + len(scores)] = both[:, width:]
        queries, rows = np.nonzero(scores >= both[:, width, None])
        self.hits.append((queries + at, scores[queries, rows], ids[rows]))
        self.waiting += len(queries)
        if self.waiting > 4 * self.top.size + SCORES_AT_A_TIME:
            self.cut()

    def cut(self) -> None:
        if not self.hits:
            return
        queries, scores, ids = (np.concatenate(parts) for parts in zip(*self.hits))
        least = self.top[queries, 0]
        above, tied = np.flatnonzero(scores > least), np.flatnonzero(scores == least)
        room = self.n - np.bincount(queries[above], minlength=len(self.top))
        tied = tied[np.lexsort((ids[tied], queries[tied]))]
        owner = queries[tied]
        place = np.arange(len(tied)) - np.searchsorted(owner, owner)
        kept = np.concatenate([above, tied[place < room[owner]]])
        self.hits, self.waiting = [(queries[kept], scores[kept], ids[kept])], len(kept)


def _hit_table(query_ids: pa.Array, queries: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> pa.Table:
    columns = [query_ids.take(pa.array(queries)), pa.array(ids.astype(object), pa.string()), pa.array(scores)]
    return pa.table(columns, schema=pa.schema(SCORE_FIELDS))


def _block_rows(vectors: DataFrame) -> int:
    """Rows of a block of queries, by the width of a vector."""
    widest = vectors.select(F.max(F.size("embedding"))).head()[0] or 1
    return max(1, min(MAX_CARRIED_QUERIES, MAX_CARRIED_BYTES // (8 * max(1, widest))))


def vector_scores(query_vectors: DataFrame, vectors: DataFrame, n: int = -1) -> DataFrame:
    """(query_id, post_id, score) of every pair, or of at least the n best per query.

    Rows without a direction (null, empty or all zero) have no cosine and are left out.
    """
    queries = query_vectors.select(F.col("query_id").cast("string"), "embedding")
    posts = vectors.select(F.col("post_id").cast("string"), "embedding")
    return _on_vectors(queries, posts, _scores_of_all(n), SCORES, _block_rows(queries))


def _on_vectors(queries: DataFrame, posts: DataFrame, work, schema: str, block: int, shard=SHARD_ROWS) -> DataFrame:
    """What `work` (a table of queries, an iterator of tables of vectors) yields over all
    vectors for all queries. Up to `block` queries travel with the tasks; more are laid out with
    the vectors on a grid of vector shards x query blocks. Shards and blocks go by hash, so
    their sizes are even whatever the data."""
    carried = queries.limit(block + 1).toArrow()
    if carried.num_rows <= block:

        def run(batches):
            for table in work(carried, (pa.Table.from_batches([batch]) for batch in batches)):
                yield from table.to_batches()

        return posts.mapInArrow(run, schema)

    n_shards = max(1, -(-posts.count() // shard))
    n_blocks = max(1, -(-queries.count() // block))

    def spread(df, by, own, own_count, other, other_count):
        return df.withColumn(own, F.pmod(F.xxhash64(by), F.lit(own_count))).withColumn(
            other, F.explode(F.sequence(F.lit(0), F.lit(other_count - 1)))
        ).withColumn(other, F.col(other).cast("bigint"))

    left = spread(posts, "post_id", "shard", n_shards, "block", n_blocks)
    right = spread(queries, "query_id", "block", n_blocks, "shard", n_shards)

    def run_group(post_table, query_table):
        return pa.concat_tables([empty, *work(query_table, iter([post_table]))])

    empty = pa.schema([(name, _ARROW[kind]) for name, kind in (field.split() for field in schema.split(", "))]).empty_table()
    return left.groupBy("shard", "block").cogroup(right.groupBy("shard", "block")).applyInArrow(run_group, schema)


_ARROW = {"string": pa.string(), "double": pa.float64(), "bigint": pa.int64(), "int": pa.int32()}


def _scores_of_all(n: int):
    """Every pair for n < 0; else one table with the n best of each query over all tables."""

    def work(queries: pa.Table, tables):
        query_rows, mask = _unit_matrix(queries["embedding"])
        query_ids = queries["query_id"].combine_chunks().filter(pa.array(mask))
        best = _Best(len(query_rows), max(n, 0))
        for rows, ids in _unit_tables(tables):
            if not len(rows) or not len(query_rows) or n == 0:
                continue
            for at, scores in _score_blocks(query_rows, rows):
                if n > 0:
                    best.add(at, scores, ids)
                else:
                    numbers = np.repeat(np.arange(at, at + len(scores)), len(ids))
                    yield _hit_table(query_ids, numbers, scores.ravel(), np.tile(ids, len(scores)))
        best.cut()
        for queries_found, scores, ids in best.hits:
            yield _hit_table(query_ids, queries_found, scores, ids)

    return work


def _before_places(scores: np.ndarray, nth_id: np.ndarray, place_scores: np.ndarray, first_id) -> np.ndarray:
    """For each place the number of hits in front of it: those with a higher score, and those
    with its score and a lesser id. `first_id` gives, for numbers of places, how many of the
    ids are less, `nth_id` the number of a hit's id in their order."""
    order = np.argsort(scores)
    ascending = scores[order]
    low, high = np.searchsorted(ascending, place_scores, "left"), np.searchsorted(ascending, place_scores, "right")
    before = len(scores) - high
    met = np.flatnonzero(low < high)
    if len(met):
        least = first_id(met)
        alone = high[met] - low[met] == 1
        before[met[alone]] += nth_id[order[low[met[alone]]]] < least[alone]
        for j, bound in zip(met[~alone], least[~alone]):
            before[j] += np.count_nonzero(nth_id[order[low[j] : high[j]]] < bound)
    return before


def _counts_between(queries: pa.Table, tables):
    """(query_id, slot, n): how many vectors lie in front of the slot-th place of a query and
    not in front of an earlier one. A task sends its sums only."""
    query_rows, mask = _unit_matrix(queries["embedding"])
    kept = queries.filter(pa.array(mask))
    places = [
        (np.array(scores, np.float64), np.array(ids, str))
        for scores, ids in zip(kept["place_scores"].to_pylist(), kept["place_ids"].to_pylist())
    ]
    totals = [np.zeros(len(scores) + 1, np.int64) for scores, _ in places]
    for rows, ids in _unit_tables(tables):
        if not len(rows) or not places:
            continue
        by_id = np.argsort(ids, kind="stable")
        nth_id, sorted_ids = np.empty(len(ids), np.int64), ids[by_id]
        nth_id[by_id] = np.arange(len(ids))
        for at, scores in _score_blocks(query_rows, rows):
            for j, row in enumerate(scores, at):
                place_scores, place_ids = places[j]
                before = _before_places(row, nth_id, place_scores, lambda met: np.searchsorted(sorted_ids, place_ids[met]))
                totals[j] += np.diff(before, prepend=0, append=len(row))
    names = kept["query_id"].to_pylist()
    found = [(name, slot, n) for name, total in zip(names, totals) for slot, n in enumerate(total.tolist()) if n]
    if found:
        yield pa.table([list(column) for column in zip(*found)], schema=pa.schema([("query_id", pa.string()), ("slot", pa.int32()), ("n", pa.int64())]))


def vector_places(candidates: DataFrame, query_vectors: DataFrame, vectors: DataFrame) -> DataFrame:
    """(query_id, post_id, rank) of candidates (query_id, post_id) in the rankings of all
    vectors, without those rankings: the candidates' own scores give places, and one pass over
    the vectors counts how many lie between them."""
    queries = query_vectors.select(F.col("query_id").cast("string"), "embedding")
    posts = vectors.select(F.col("post_id").cast("string"), "embedding")
    pairs = candidates.join(posts, "post_id").join(queries.withColumnRenamed("embedding", "asked"), "query_id")

    def score_pairs(batches):
        for batch in batches:
            table = pa.Table.from_batches([batch])
            left, usable = _unit_matrix(table["embedding"])
            right, asked = _unit_matrix(table["asked"])
            both = usable & asked
            scores = np.round((left[both[usable]] * right[both[asked]]).sum(axis=1), 6) + 0.0
            kept = table.filter(pa.array(both))
            yield from pa.table([kept["query_id"], kept["post_id"], pa.array(scores)], schema=pa.schema(SCORE_FIELDS)).to_batches()

    scored = pairs.mapInArrow(score_pairs, SCORES)
    places = scored.groupBy("query_id").agg(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("s"), "post_id"))).alias("places"))
    asked = stage(
        queries.join(places, "query_id").select(
            "query_id", "embedding", F.transform("places", lambda p: -p["s"]).alias("place_scores"),
            F.transform("places", lambda p: p["post_id"]).alias("place_ids"),
        ), "places",
    )
    most = asked.agg(F.max(F.size("place_ids"))).first()[0] or 0
    # Places travel with the queries and count among their bytes.
    block = max(1, _block_rows(asked) // (1 + most // 64))
    counts = _on_vectors(asked, posts, _counts_between, "query_id string, slot int, n bigint", block)
    slots = counts.groupBy("query_id", F.col("slot").alias("nth")).agg(F.sum("n").alias("n"))
    up_to = Window.partitionBy("query_id").orderBy("nth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        asked.select("query_id", F.posexplode("place_ids").alias("nth", "post_id")).join(slots, ["query_id", "nth"], "left")
        .select("query_id", "post_id", (F.coalesce(F.sum("n").over(up_to), F.lit(0)) + 1).alias("rank"))
    )


def vector_search(query_vectors: DataFrame, vectors: DataFrame, n: int = 10) -> DataFrame:
    """Best n posts per query vector: (query_id, post_id, score, rank)."""
    return topk(vector_scores(query_vectors, vectors, n), n)
