"""Look-ups between posts, ids, hits and batches.

The small side (ids, hits, a batch) is always the one that may be broadcast, and Spark
decides that from its size; nothing here forces a broadcast of a size nobody checked.
"""

from pyspark.sql import DataFrame, functions as F

from postlake.functions.text import clean_markup
from postlake.functions.times import time_text

# Hits up to this many rows are broadcast if they have short columns only (some 10 MB); what
# else a hit carries has no known size, and Spark goes by the size it finds.
MAX_BROADCAST_HITS = 100_000
SHORT_COLUMNS = {"query_id", "post_id", "score", "rank", "method"}


def _bounded(hits: DataFrame, max_hits: int | None) -> DataFrame:
    """`max_hits` is a bound the caller has proved, such as queries x hits per query."""
    small = max_hits is not None and max_hits <= MAX_BROADCAST_HITS and set(hits.columns) <= SHORT_COLUMNS
    return F.broadcast(hits) if small else hits


def lookup_ids(posts: DataFrame, ids: DataFrame) -> DataFrame:
    """Posts whose id is in the given set, of any size."""
    return posts.join(ids.select("post_id"), "post_id", "left_semi")


def join_hits(hits: DataFrame, posts: DataFrame, max_hits: int | None = None) -> DataFrame:
    """Hits with their posts' columns; hits without a post are dropped."""
    return _bounded(hits, max_hits).join(posts, "post_id")


def enrich_hits(hits: DataFrame, posts: DataFrame, max_hits: int | None = None) -> DataFrame:
    """Every hit (post_id, score, snippet, ...) with post columns or defaults.

    A hit without a post shows its cleaned snippet and zero counts. A null of a post that
    does exist stays null. Posts are first cut to those hit, so the archive is scanned
    but not shuffled while the hits are small.
    """
    found = _bounded(hits.select("post_id").distinct(), max_hits).join(
        posts.select(
            "post_id",
            F.col("created_at"),
            F.col("content").alias("post_content"),
            "like_count", "repost_count", "view_count",
            F.lit(True).alias("found"),
        ),
        "post_id",
    )
    joined = hits.join(found, "post_id", "left")
    missing = F.col("found").isNull()
    extra = [c for c in hits.columns if c not in ("post_id", "score", "snippet")]
    return joined.select(
        *extra,
        "post_id",
        time_text(F.col("created_at")).alias("created_at"),
        # Only snippets that are shown go through the clean-up.
        F.when(missing, clean_markup(F.when(missing, F.coalesce("snippet", F.lit("")))))
        .otherwise(F.col("post_content")).alias("content"),
        *[
            F.when(missing, F.lit(0)).otherwise(F.col(c)).alias(c)
            for c in ["like_count", "repost_count", "view_count"]
        ],
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )


def boundary_seen(batch: DataFrame, archive: DataFrame) -> DataFrame:
    """One row: does any id of the batch exist in the archive?"""
    shared = lookup_ids(archive.select("post_id"), batch)
    return shared.agg((F.count("*") > 0).alias("overlaps"))
