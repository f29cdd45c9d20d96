"""N-gram Jaccard join by T-occurrence search (DivideSkip; Li, Lu and Lu, 2008).

Two documents link when the Jaccard similarity of their shingle sets reaches a bound. A
document that links must share T shingles, so it is found by merging inverted lists and
counting. The work is laid out so that only documents that can link reach a merge:

1. Every text becomes its set of 64-bit shingle hashes; of each set a prefix in hash order is
   kept, long enough that two linked sets share several prefix entries (`SHARED_PERCENT`).
2. Lengths of the inverted lists of all prefix entries are counted over all documents: blocks
   of documents send their distinct entries to shards by hash range and get the counts back.
   A hot entry is one number per block. Documents with too few shared entries are done.
3. Of the rest, equal sets are one class, and each class keeps its shortest prefix lists.
   Classes on a common list form units; any two linked sets fall into the same unit. A unit
   too large for one task is cut into blocks, and pairs of blocks are units.
4. In each unit, DivideSkip: the short lists of a set are merged and counted, the L longest
   are only probed by binary search for candidates that reached T - L, and those that reach
   the overlap are links. Units give a spanning forest of links and the number of links.

Shingles are compared by their 64-bit hashes.

Edge cases: a null or empty text, or one of white space, has an empty set and links with
nothing. Equal sets link. `doc_id` names a document: rows that repeat it are returned each,
with their own set, in one component if the id is the least of its set; a null id is returned
with a null component, is counted among the copies of an equal set that has an id, and links
with nothing else. Further columns are ignored. An empty table gives an empty result.
"""

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from postlake.llm.graph import connected_components, local_roots
from postlake.llm.words import U, shingle_sets, text_chunks
from postlake.session import stage

#: Linked sets share at least this percentage of their entries within their prefixes.
SHARED_PERCENT = 10
#: Prefix entries of one shard, and shingles of one unit or block of a unit.
SHARD_KEYS = 1_000_000
UNIT_SHINGLES = 1_000_000
#: Lists longer than this may be set aside by DivideSkip.
LONG_LIST = 64

BLOCKS = (
    "block bigint, doc_ids array<bigint>, sizes array<int>, digests array<binary>, "
    "lengths array<int>, entries binary"
)


def needed_overlap(size, percent: int):
    """Least overlap of a set of this size with any set it links with."""
    return -(-percent * size // 100)


def _prefix_length(size: int, percent: int) -> int:
    return min(size, size - needed_overlap(size, percent) + max(1, size * SHARED_PERCENT // 100))


def _needed_shared(size, percent: int):
    """Prefix entries that a set shares with any set it links with, at least."""
    return np.maximum(1, needed_overlap(size, percent) * SHARED_PERCENT // 100)


def digest(entries: np.ndarray) -> bytes:
    return hashlib.blake2b(entries.tobytes(), digest_size=16).digest()


def _set_blocks(k: int, percent: int):
    def run(batches):
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            ids = batch.column(0)
            for first, texts in text_chunks(batch, "text"):
                sets = shingle_sets(texts, k)
                kept = [s[: _prefix_length(len(s), percent)] for s in sets]
                yield pa.RecordBatch.from_pydict({
                    "block": pa.array([block], pa.int64()),
                    "doc_ids": pa.array([ids.slice(first, len(texts)).to_pylist()], pa.list_(pa.int64())),
                    "sizes": pa.array([[len(s) for s in sets]], pa.list_(pa.int32())),
                    "digests": [[digest(s) for s in sets]],
                    "lengths": pa.array([[len(s) for s in kept]], pa.list_(pa.int32())),
                    "entries": [np.concatenate([np.zeros(0, U), *kept]).tobytes()],
                })
                block += 1

    return run


def _requests(shards: int):
    """Distinct entries of a block with their counts, cut by hash range."""
    shift = U(64 - shards.bit_length() + 1)

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                keys, counts = np.unique(np.frombuffer(row["entries"], U), return_counts=True)
                shard = (keys >> shift).astype(np.int64) if shards > 1 else np.zeros(len(keys), np.int64)
                cuts = np.searchsorted(shard, np.arange(shards + 1))
                for i in np.flatnonzero(np.diff(cuts)):
                    a, b = cuts[i], cuts[i + 1]
                    yield pa.RecordBatch.from_pydict({
                        "shard": pa.array([i], pa.int64()),
                        "block": pa.array([row["block"]], pa.int64()),
                        "keys": [keys[a:b].tobytes()],
                        "counts": [counts[a:b].astype(np.uint32).tobytes()],
                    })

    return run


def _count_lists(asked: pd.DataFrame) -> pd.DataFrame:
    """Per block the lengths of the lists it asked for, in the order of its entries."""
    keys = [np.frombuffer(x, U) for x in asked["keys"]]
    known, places = np.unique(np.concatenate(keys), return_inverse=True)
    weights = np.concatenate([np.frombuffer(x, np.uint32) for x in asked["counts"]])
    lengths = np.bincount(places, weights=weights, minlength=len(known)).astype(np.uint32)[places]
    cuts = np.cumsum([len(x) for x in keys])[:-1]
    return pd.DataFrame({
        "block": asked["block"], "shard": asked["shard"],
        "lengths": [x.tobytes() for x in np.split(lengths, cuts)],
    })


def _keep_able(percent: int):
    """Documents with enough shared entries, and their shortest lists."""

    def run(blocks: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        out = []
        answers = answers.sort_values("shard")
        for row in blocks.itertuples():
            entries = np.frombuffer(row.entries, U)
            keys = np.unique(entries)
            known = np.concatenate([np.zeros(0, np.uint32), *(
                np.frombuffer(x, np.uint32) for x in answers.loc[answers["block"] == row.block, "lengths"]
            )])
            lists = known[np.searchsorted(keys, entries)]
            ends = np.cumsum(row.lengths)
            shared = np.diff(np.concatenate([[0], np.cumsum(lists > 1)])[np.concatenate([[0], ends])])
            sizes = np.asarray(row.sizes, np.int64)
            able = (sizes > 0) & (shared >= _needed_shared(sizes, percent))
            for i in np.flatnonzero(able):
                own = slice(ends[i] - row.lengths[i], ends[i])
                order = np.lexsort((entries[own], lists[own]))
                order = order[: len(order) - int(_needed_shared(sizes[i], percent)) + 1]
                order = order[lists[own][order] > 1]
                if len(order) and row.doc_ids[i] is not None:
                    out.append((int(row.doc_ids[i]), row.digests[i], int(sizes[i]),
                                entries[own][order].view(np.int64)))
        return pd.DataFrame(out, columns=["doc_id", "digest", "size", "entries"])

    return run


def divide_skip(sets: list, side: np.ndarray, percent: int):
    """Links (i, j, overlap arrays) of sets by T-occurrence search.

    Sets are taken by size, each against those that come later, so T follows from its own
    size. Where `side` holds 0 and 1, only links between the two sides are looked for.
    """
    sizes = np.array([len(s) for s in sets])
    order = np.argsort(sizes, kind="stable")
    sizes, side = sizes[order], side[order]
    flat = np.concatenate([sets[i] for i in order])
    owners = np.repeat(np.arange(len(order)), sizes)
    tokens = np.unique(flat, return_inverse=True)[1]
    by_token = np.argsort(tokens, kind="stable")
    lists = owners[by_token]
    heads = np.concatenate([[0], np.cumsum(np.bincount(tokens, minlength=1))])
    lengths = np.diff(heads)
    many = len(order)
    keys = tokens[by_token].astype(np.int64) * many + lists
    begins = np.concatenate([[0], np.cumsum(sizes)])
    two_sides = bool(side.any())
    for i in range(many):
        own = tokens[begins[i] : begins[i + 1]]
        own = own[lengths[own] > 1]
        least = -(-2 * percent * int(sizes[i]) // (100 + percent))
        if len(own) < least or not len(own):
            continue
        own = own[np.argsort(lengths[own], kind="stable")]
        n_long = min(least - 1, int((lengths[own] > LONG_LIST).sum()))
        short, long = own[: len(own) - n_long], own[len(own) - n_long :]
        span = lengths[short]
        gather = np.repeat(heads[short] - (np.cumsum(span) - span), span) + np.arange(span.sum())
        merged = np.sort(lists[gather][lists[gather] > i])
        if not len(merged):
            continue
        edge = np.flatnonzero(np.concatenate([[True], merged[1:] != merged[:-1]]))
        found, counts = merged[edge], np.diff(np.concatenate([edge, [len(merged)]]))
        fits = (counts >= least - n_long) & (percent * sizes[found] <= 100 * sizes[i])
        if two_sides:
            fits &= side[found] != side[i]
        found, counts = found[fits], counts[fits]
        wanted = -(-percent * (sizes[i] + sizes[found]) // (100 + percent))
        # The longest lists last; a candidate goes as soon as it can no longer get there.
        step = max(1, 200_000 // max(1, len(found)))
        for at in range(0, n_long, step):
            probed = long[at : at + step]
            alive = counts + (n_long - at) >= wanted
            found, counts, wanted = found[alive], counts[alive], wanted[alive]
            if not len(found):
                break
            probes = probed[:, None].astype(np.int64) * many + found
            places = np.searchsorted(keys, probes)
            hits = keys[np.minimum(places, len(keys) - 1)] == probes
            counts = counts + hits.sum(axis=0)
        good = counts >= wanted
        if good.any():
            yield order[i], order[found[good]], counts[good]


def _search_units(percent: int):
    def run(unit: pd.DataFrame) -> pd.DataFrame:
        # Rows that repeat a document are counted among its copies already; an id may name
        # several sets.
        unit = unit.drop_duplicates(["doc_id", "digest"])
        ids, digests = unit["doc_id"].to_numpy(), unit["digest"].to_numpy()
        copies = unit["copies"].to_numpy()
        side = unit["side"].to_numpy()
        # A pair of blocks of which the higher has no set; the lower is a unit of its own too.
        alone = bool(unit["pair"].iloc[0]) and not side.any()
        sets = [np.frombuffer(x, U) for x in unit["entries"]]
        a, b, degree = [], [], np.zeros(len(ids), np.int64)
        for i, partners, _ in () if alone else divide_skip(sets, side, percent):
            a.append(np.full(len(partners), ids[i]))
            b.append(ids[partners])
            degree[i] += copies[partners].sum()
            degree[partners] += copies[i]
        if not a:
            return pd.DataFrame(columns=["a", "b", "n_links", "digest"])
        nodes, roots = local_roots(np.concatenate(a), np.concatenate(b))
        linked = degree > 0
        none = np.zeros(int(linked.sum()), np.int64)
        return pd.concat([
            pd.DataFrame({"a": nodes, "b": roots, "n_links": 0, "digest": None}),
            pd.DataFrame({"a": ids[linked], "b": ids[linked], "n_links": degree[linked] + none, "digest": digests[linked]}),
        ])

    return run


def _full_sets(k: int):
    """Rows with a text that has the digest asked for, with the whole set."""

    def run(batches):
        for batch in batches:
            names = [n for n in batch.schema.names if n != "text"]
            for first, texts in text_chunks(batch, "text"):
                sets = shingle_sets(texts, k)
                asked = batch.column(batch.schema.get_field_index("digest")).slice(first, len(texts)).to_pylist()
                same = [i for i, s in enumerate(sets) if digest(s) == asked[i]]
                if same:
                    part = batch.slice(first, len(texts)).take(pa.array(same, pa.int64())).select(names)
                    yield pa.RecordBatch.from_arrays(
                        [*part.columns, pa.array([sets[i].tobytes() for i in same], pa.binary())],
                        names=[*names, "entries"],
                    )

    return run


def _shard_count(n: int) -> int:
    """A power of two of shards for so many keys."""
    return 1 << max(3, (n // SHARD_KEYS).bit_length())


def _units(classes: DataFrame, components: DataFrame) -> DataFrame:
    """(doc_id, digest, copies, units): where each class is searched, as (unit, side, pair).
    Of a pair of blocks only links between its sides are looked for."""
    placed = classes.join(components, F.col("doc_id") == F.col("node"))
    weights = placed.groupBy("component").agg(F.sum("size").alias("weight"))
    total = weights.agg(F.sum("weight")).first()[0] or 0
    bins = max(8, total // UNIT_SHINGLES + 1)
    placed = placed.join(weights, "component").withColumn(
        "parts", F.ceil(F.col("weight") / F.lit(UNIT_SHINGLES)).cast("bigint")
    ).withColumn("part", F.pmod(F.xxhash64("doc_id"), F.col("parts")))
    pairs = F.transform(
        F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1),
        lambda other: F.struct(
            F.concat_ws("-", "component", F.least("part", other), F.greatest("part", other)).alias("unit"),
            F.when(F.col("part") > other, 1).otherwise(0).alias("side"), (F.col("part") != other).alias("pair"),
        ),
    )
    alone = F.array(F.struct(
        F.pmod(F.xxhash64("component"), F.lit(bins)).cast("string").alias("unit"), F.lit(0).alias("side"),
        F.lit(False).alias("pair"),
    ))
    return placed.select(
        "doc_id", "digest", "copies", F.when(F.col("parts") > 1, pairs).otherwise(alone).alias("units")
    )


def jaccard_components(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, n_links) per row of documents.

    Documents link when 100 * intersection >= percent * union of their k-word shingle sets.
    component_id is the least doc_id reachable by links, n_links the number of documents
    linked directly. Runs jobs when called.
    """
    blocks = stage(docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(_set_blocks(k, percent), BLOCKS), "sets")
    rows = blocks.select(F.explode(F.arrays_zip("doc_ids", "sizes", "digests")).alias("x")).select(
        F.col("x.doc_ids").alias("doc_id"), F.col("x.sizes").cast("bigint").alias("n_shingles"),
        F.col("x.digests").alias("digest"),
    )
    entries = blocks.agg(F.sum(F.octet_length("entries")) / 8).first()[0] or 0
    asked = blocks.mapInArrow(_requests(_shard_count(int(entries))), "shard bigint, block bigint, keys binary, counts binary")
    answers = asked.groupBy("shard").applyInPandas(_count_lists, "block bigint, shard bigint, lengths binary")
    able = stage(
        # Ids as texts: a list of numbers with a null in it reaches pandas in floating point.
        blocks.withColumn("doc_ids", F.col("doc_ids").cast("array<string>")).groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(
            _keep_able(percent), "doc_id bigint, digest binary, size bigint, entries array<bigint>"
        ),
        "able",
    )
    # Equal sets are one class, named by its least id; the copies are counted over all rows.
    classes = rows.where("n_shingles > 0").groupBy("digest").agg(
        F.min("doc_id").alias("head"), F.count("*").alias("copies")
    ).where("head is not null")
    heads = stage(
        able.join(classes, "digest").where("doc_id = head").dropDuplicates(["doc_id", "digest"]).drop("head"), "classes"
    )
    listed = heads.select("doc_id", F.explode("entries").alias("entry"))
    lists = listed.groupBy("entry").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high")
    together = connected_components(
        listed.join(lists, "entry").select(F.col("doc_id").alias("a"), F.col("low").alias("b"))
    )
    # Sets of one id are in one component, but only links between ids are in `together`.
    several = heads.groupBy("doc_id").count().where("count > 1").select(F.col("doc_id").alias("node"))
    together = together.union(several.join(together, "node", "left_anti").select("node", F.col("node").alias("component")))
    units = _units(heads, together)
    sets = docs.select(F.col("doc_id").cast("bigint"), "text").join(units, "doc_id").mapInArrow(
        _full_sets(k), "doc_id bigint, digest binary, copies bigint, units array<struct<unit:string,side:int,pair:boolean>>, entries binary"
    )
    found = stage(
        sets.select("doc_id", "digest", "copies", "entries", F.explode("units").alias("u"))
        .select("doc_id", "digest", "copies", "entries", "u.unit", "u.side", "u.pair")
        .groupBy("unit").applyInPandas(_search_units(percent), "a bigint, b bigint, n_links bigint, digest binary"),
        "links",
    )
    components = connected_components(found.select("a", "b"))
    degrees = found.where("n_links > 0").groupBy("digest").agg(F.sum("n_links").alias("linked"))
    named = classes.join(components, F.col("head") == F.col("node"), "left").drop("node").join(
        degrees, "digest", "left"
    )
    return rows.join(named.select("digest", "head", "copies", "component", "linked"), "digest", "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "head", "doc_id")).alias("component_id"),
        F.coalesce(F.col("copies") - 1 + F.coalesce("linked", F.lit(0)), F.lit(0)).alias("n_links"),
    )


def near_duplicates_removed(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """One document of each component stays: the one whose id names it. Of rows that repeat a
    kept id the whole set of rows stays, as they are one document; a null id always stays."""
    found = jaccard_components(docs, k, percent).where("component_id <> doc_id").select("doc_id").distinct()
    return docs.join(found, "doc_id", "left_anti")
