"""The inverted index: postings, term statistics and totals, in memory or stored.

Postings are made where the posts are: the tokens of a few posts at a time are sorted as numbers
and cut into runs, one per post, term and field. Nothing is shuffled, so an index build costs one
scan. Each posting carries its post's length, so ranking needs no join with
the posts.

A stored index is a row of segments. The first holds all posts; every update adds one with
the postings of its own posts, the ids whose older postings no longer count, and the signed
differences of the figures. A search reads all segments as one table and leaves out what a
later segment replaced, so an update writes no more than its batch; `merge_segments` makes
one segment of all when there are many. Postings lie in folders by a hash of their term, so
the words asked for, however many, tell which folders are read, and below by the class of
their post's length (`zone`). All postings of a post are in one zone, and `bounds` keeps for
each term and zone the figures that limit what a posting there can add to a score, so a search
for the best n can leave zones out.
"""

import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from postlake.functions.text import tokens
from postlake.operators.joins import lookup_ids
from postlake.schemas import POSTINGS
from postlake.session import drop_stage, drop_stage_part, save, stage
from postlake.sources.segments import folder, markers, only_live, publish, read_segments, replaced_since

# The code that makes postings travels with the tasks, so executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Tokens that a task sorts at a time, about; one post's are sorted together.
TOKENS_AT_A_TIME = 500_000

#: Folders of a segment's postings, unless write_index is given another number. What is read
#: for a word is about this part of the index, but files should stay large.
BUCKETS = 32


#: Parts of the buckets in which a segment's postings are laid out one after the other, if there
#: are more of them than so many.
PARTS = 8
PART_ROWS = 1_000_000


@dataclass(frozen=True)
class TextIndex:
    """postings (schema POSTINGS with `bucket`, `zone` and `segment`), term_stats (term, field,
    df, lead_df), totals (one row); `replaced` says for ids of older segments since which
    segment they do not count (post_id, since), None with one segment; `bounds` (term, field,
    zone, max_tf, min_len) limits the postings of a zone, None if the index is not stored."""

    postings: DataFrame
    term_stats: DataFrame
    totals: DataFrame
    buckets: int = BUCKETS
    replaced: DataFrame | None = None
    fields: tuple = ("content",)
    fold: bool = True
    bounds: DataFrame | None = None


def tokenize(posts: DataFrame, column: str = "content", fold: bool = True) -> DataFrame:
    """(post_id, pos, term) with positions from 0."""
    return posts.select("post_id", F.posexplode(tokens(F.col(column), fold)).alias("pos", "term"))


def _field_tokens(field: str, fold: bool) -> Column:
    """Tokens of one field in order; none for a null text."""
    return F.coalesce(tokens(F.col(field), fold), F.array().cast("array<string>"))


def bucket_of(term: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


def zone_of(doc_len: Column) -> Column:
    """Posts of one zone differ in length by a factor of four at most."""
    return F.floor(F.log2(doc_len) / 2).cast("int")


def build_postings(posts: DataFrame, fields=("content",), fold: bool = True) -> DataFrame:
    """One row per term, field and post: tf, positions and the post's whole length.

    `lead` marks one of a term's rows per post, so posts can be counted without a distinct.
    """
    names = list(fields)
    split = posts.select("post_id", *[_field_tokens(f, fold).alias(f"t{i}") for i, f in enumerate(names)])

    def run(batches):
        for batch in batches:
            yield from _runs(batch, names)

    return split.mapInArrow(run, T.StructType([
        T.StructField(c.name, posts.schema["post_id"].dataType if c.name == "post_id" else c.dataType) for c in POSTINGS.fields
    ]))


def _runs(batch: pa.RecordBatch, names: list):
    """Postings of some posts, given as post_id and the tokens of each field; a few posts at a time."""
    lengths = [pc.list_value_length(column).to_numpy(zero_copy_only=False) for column in batch.columns[1:]]
    ends = np.cumsum(sum(lengths, np.zeros(batch.num_rows, np.int64)))
    at = 0
    while at < batch.num_rows:
        done = ends[at - 1] if at else 0
        upto = max(at + 1, int(np.searchsorted(ends, done + TOKENS_AT_A_TIME, "right")))
        if ends[upto - 1] > done:
            yield _runs_of(batch.slice(at, upto - at), [n[at:upto] for n in lengths], names)
        at = upto


def _runs_of(batch: pa.RecordBatch, lengths: list, names: list) -> pa.RecordBatch:
    rows = np.concatenate([np.repeat(np.arange(len(n)), n) for n in lengths])
    places = np.concatenate([np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) for n in lengths])
    field_order = np.argsort(np.argsort(names))
    field = np.repeat(field_order, [n.sum() for n in lengths])
    coded = pa.concat_arrays([column.flatten() for column in batch.columns[1:]]).dictionary_encode()
    terms, codes = coded.dictionary, coded.indices.to_numpy()
    rank = np.empty(len(terms), np.int64)
    rank[pc.sort_indices(terms).to_numpy()] = np.arange(len(terms))
    # Tokens by post and term, then by field; those of one field stay in their order.
    of_term = rows * len(terms) + rank[codes]
    key = of_term * len(names) + field
    order = np.argsort(key, kind="stable")
    key, of_term = key[order], of_term[order]
    starts = np.flatnonzero(np.diff(key, prepend=-1))
    first = order[starts]
    doc_len = sum(lengths).astype(np.int32)
    bounds = np.append(starts, len(key))
    return pa.RecordBatch.from_arrays(
        [
            terms.take(pa.array(codes[first])),
            pa.array(sorted(names)).take(pa.array(field[first])),
            batch.column(0).take(pa.array(rows[first])),
            pa.array(np.diff(bounds).astype(np.int32)),
            pa.array(doc_len[rows[first]]),
            pa.array(np.diff(of_term[starts], prepend=-1) != 0),
            pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(places[order].astype(np.int32))),
        ],
        names=POSTINGS.fieldNames(),
    )


def doc_stats(posts: DataFrame, fields=("content",), fold: bool = True) -> DataFrame:
    """(post_id, doc_len) over all indexed fields."""
    doc_len = sum((F.size(_field_tokens(f, fold)) for f in fields), F.lit(0))
    return posts.select("post_id", doc_len.alias("doc_len"))


def index_totals(stats: DataFrame) -> DataFrame:
    """One row: number of posts and of tokens. Posts without tokens count."""
    return stats.agg(
        F.count("*").alias("n_docs"), F.coalesce(F.sum("doc_len"), F.lit(0)).alias("n_tokens")
    )


def term_stats(postings: DataFrame) -> DataFrame:
    """Per term and field: posts with the term there (df), and posts counted once over all
    fields (lead_df, to be added up over the fields of a term)."""
    return postings.groupBy("term", "field").agg(
        F.count("*").alias("df"), F.count_if("lead").alias("lead_df")
    )


def build_index(posts: DataFrame, fields=("content",), fold: bool = True) -> TextIndex:
    """An index that is not stored: every search makes the postings it reads anew."""
    postings = build_postings(posts, fields, fold)
    return TextIndex(
        postings.select("*", bucket_of(F.col("term"), BUCKETS).alias("bucket"), zone_of(F.col("doc_len")).alias("zone"), F.lit(1).alias("segment")),
        term_stats(postings), index_totals(doc_stats(posts, fields, fold)), fields=tuple(fields), fold=fold,
    )


STORED_POSTINGS = T.StructType([*POSTINGS.fields, *[T.StructField(c, T.IntegerType()) for c in ("segment", "bucket", "zone")]])
STORED_BOUNDS = "term string, field string, zone int, max_tf int, min_len int, segment int"
STORED_TERMS = "term string, field string, df bigint, lead_df bigint, segment int"
STORED_TOTALS = "n_docs bigint, n_tokens bigint, segment int"
STORED_MARKERS = "name string, base boolean, buckets int, fields array<string>, fold boolean, segment int"


def published_segments(spark: SparkSession, path: str) -> list:
    """The segments that make up the index, in order: the last one that holds all posts, and
    those after it."""
    rows = markers(spark, path, STORED_MARKERS)
    return rows[max(i for i, row in enumerate(rows) if row.base):]


def _store(
    spark: SparkSession, path: str, number: int, postings: DataFrame, figures, replaced: DataFrame | None,
    buckets: int, fields, fold: bool, name: str | None = None,
) -> None:
    """Write and publish a segment. Its postings are made once and staged by PARTS of the buckets,
    then part after part brought together by bucket and zone and sorted by term and post, so that
    no more than a part is shuffled at a time; few postings are one part. Spark splits large zones
    over several tasks, so a term found in a third of all posts spreads over many files.
    `figures` gives term statistics and totals from the postings as stored."""
    order, target = ["bucket", "zone", "term", "post_id", "field"], folder(path, "postings", number)
    placed = postings.withColumns({"bucket": bucket_of(F.col("term"), buckets), "zone": zone_of(F.col("doc_len"))})
    staged = stage(placed.withColumn("part", F.col("bucket") % PARTS), "postings", lean=True, by=["part"])
    parts = [None] if staged.count() <= PART_ROWS else range(PARTS)
    for part in parts:
        own = (staged if part is None else staged.where(F.col("part") == part)).drop("part")
        laid_out = own.hint("rebalance", F.col("bucket"), F.col("zone")).sortWithinPartitions(*order)
        save(laid_out, target, "append" if part else "overwrite", ["bucket", "zone"])
        if part is not None:
            drop_stage_part(staged, "part", part)
    drop_stage(staged)
    stored = read_segments(spark, path, "postings", STORED_POSTINGS, [number])
    limits = stored.groupBy("term", "field", "zone").agg(F.max("tf").alias("max_tf"), F.min("doc_len").alias("min_len"))
    save(limits.repartitionByRange("term").sortWithinPartitions("term"), folder(path, "bounds", number), "overwrite")
    terms, totals = figures(stored)
    save(terms.repartitionByRange("term").sortWithinPartitions("term"), folder(path, "terms", number), "overwrite")
    save(totals, folder(path, "totals", number), "overwrite")
    if replaced is not None:
        save(replaced, folder(path, "replaced", number), "overwrite")
    marker = spark.createDataFrame(
        [(name, replaced is None, buckets, list(fields), fold)],
        "name string, base boolean, buckets int, fields array<string>, fold boolean",
    )
    publish(marker, path, number)


def _counted(posts: DataFrame):
    """Figures of a segment that holds all posts: all but the number of posts, which includes
    those without words, is counted from what is stored."""

    def figures(stored):
        n_docs = posts.agg(F.count("*").alias("n")).scalar()
        totals = stored.agg(F.coalesce(F.sum("tf"), F.lit(0)).alias("n_tokens")).select(n_docs.alias("n_docs"), "n_tokens")
        return term_stats(stored), totals

    return figures


def write_index(postings: DataFrame, posts: DataFrame, path: str, buckets: int = BUCKETS, fields=("content",), fold: bool = True) -> None:
    """Store the index of `posts`, whose postings are given, as the first segment of a new index."""
    _store(postings.sparkSession, path, 1, postings.select(*POSTINGS.fieldNames()), _counted(posts), None, buckets, fields, fold)


def write_segment(spark: SparkSession, path: str, changed: DataFrame, outdated: DataFrame, name: str | None = None) -> None:
    """Add an update to a stored index: `changed` are the posts that are new or have another
    text, `outdated` the posts as they were before that are changed or gone (see index_changes).
    Only these posts are tokenised and only their postings written. An update that has a name
    and was added already is not added again."""
    segments = published_segments(spark, path)
    if name is not None and any(row.name == name for row in segments):
        return
    last, (fields, fold) = segments[-1], (tuple(segments[-1].fields), segments[-1].fold)
    changed, outdated = (rows.select("post_id", *fields) for rows in (changed, outdated))

    def figures(stored):
        old = build_postings(outdated, fields, fold)
        signed = term_stats(stored).unionByName(
            term_stats(old).select("term", "field", (-F.col("df")).alias("df"), (-F.col("lead_df")).alias("lead_df"))
        )
        lengths = doc_stats(changed, fields, fold).select(F.lit(1).alias("sign"), "doc_len").union(
            doc_stats(outdated, fields, fold).select(F.lit(-1), "doc_len")
        )
        totals = lengths.agg(
            F.coalesce(F.sum("sign"), F.lit(0)).cast("bigint").alias("n_docs"),
            F.coalesce(F.sum(F.col("sign") * F.col("doc_len")), F.lit(0)).alias("n_tokens"),
        )
        return signed.groupBy("term", "field").agg(F.sum("df").alias("df"), F.sum("lead_df").alias("lead_df")), totals

    replaced = changed.select("post_id").union(outdated.select("post_id")).distinct()
    _store(spark, path, last.segment + 1, build_postings(changed, fields, fold), figures, replaced, last.buckets, fields, fold, name)


def merge_segments(spark: SparkSession, path: str) -> None:
    """One segment of all, as a new one beside them: readers of the old ones go on."""
    segments = published_segments(spark, path)
    index = read_index(spark, path)
    _store(
        spark, path, segments[-1].segment + 1, live_postings(index), lambda _: (index.term_stats, index.totals),
        None, index.buckets, index.fields, index.fold,
    )


def read_index(spark: SparkSession, path: str) -> TextIndex:
    """The stored index as its published segments stand now."""
    segments = published_segments(spark, path)
    numbers, last = [row.segment for row in segments], segments[-1]
    terms = read_segments(spark, path, "terms", STORED_TERMS, numbers).drop("segment")
    totals = read_segments(spark, path, "totals", STORED_TOTALS, numbers).agg(
        F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens")
    )
    if len(numbers) > 1:
        terms = terms.groupBy("term", "field").agg(F.sum("df").alias("df"), F.sum("lead_df").alias("lead_df")).where("df > 0")
    return TextIndex(
        read_segments(spark, path, "postings", STORED_POSTINGS, numbers), terms, totals, last.buckets,
        replaced_since(spark, path, numbers), tuple(last.fields), last.fold,
        read_segments(spark, path, "bounds", STORED_BOUNDS, numbers).drop("segment"),
    )


def live_postings(index: TextIndex) -> DataFrame:
    """All postings that count, with the schema POSTINGS."""
    return only_live(index.postings, index.replaced).select(*POSTINGS.fieldNames())


def index_changes(batch: DataFrame, archive: DataFrame, removed: DataFrame | None = None, fields=("content",)) -> tuple[DataFrame, DataFrame]:
    """(changed, outdated) for write_segment, of a batch that will be put into the archive and
    of ids that will leave it. Only the archive's posts of these ids are looked at."""
    texts = F.struct(*fields)
    old = lookup_ids(archive, batch).select("post_id", texts.alias("old"))
    judged = stage(
        batch.select("post_id", texts.alias("new")).join(old, "post_id", "left").where(
            F.col("old").isNull() | ~F.col("new").eqNullSafe(F.col("old"))
        ), "index-changes",
    )
    outdated = judged.where("old is not null").select("post_id", "old.*")
    if removed is not None:
        gone = lookup_ids(archive, removed.join(batch, "post_id", "left_anti"))
        outdated = outdated.unionByName(gone.select("post_id", *fields))
    return judged.select("post_id", "new.*"), outdated


def refresh_postings(
    postings: DataFrame, changed: DataFrame, removed: DataFrame, fields=("content",), fold: bool = True
) -> DataFrame:
    """Postings after an update, without tokenising posts whose text is the same.

    `changed` holds new and changed posts, `removed` the ids of posts that are gone. For an
    index that is not stored; a stored one takes the update as a segment.
    """
    stale = changed.select("post_id").unionByName(removed.select("post_id"))
    return postings.join(stale, "post_id", "left_anti").select(*postings.columns).unionByName(
        build_postings(changed, fields, fold)
    )


def changed_posts(before: DataFrame, after: DataFrame, fields=("content",)) -> tuple[DataFrame, DataFrame]:
    """(posts to index again, ids to drop) between two archives, comparing text digests."""

    def digests(posts, name):
        texts = F.struct(*fields)
        return posts.select("post_id", F.sha2(F.to_json(texts, {"ignoreNullFields": "false"}), 256).alias(name))

    both = digests(before, "old").join(digests(after, "new"), "post_id", "full_outer")
    changed = both.where(F.col("new").isNotNull() & ~F.col("old").eqNullSafe(F.col("new")))
    removed = both.where(F.col("new").isNull()).select("post_id")
    return after.join(changed.select("post_id"), "post_id", "left_semi"), removed
