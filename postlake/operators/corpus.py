"""Rendering posts as text documents and comparing two corpora."""

from pyspark.sql import DataFrame, functions as F

from postlake.functions.times import day_text


def render_body(posts: DataFrame) -> DataFrame:
    """(post_id, file_name, body, created_at), one row per post that is no repost."""
    body = F.concat(
        day_text(F.col("created_at")),
        F.lit(" | "),
        F.coalesce("like_count", F.lit(0)).cast("string"),
        F.lit(" likes\n\n"),
        F.coalesce("content", F.lit("")),
        F.lit("\n"),
    )
    return posts.where(F.col("is_repost") == 0).select(
        "post_id",
        F.concat("post_id", F.lit(".txt")).alias("file_name"),
        body.alias("body"),
        "created_at",
    )


def corpus_diff(expected: DataFrame, present: DataFrame) -> DataFrame:
    """(file_name, change): written (new or different), removed or unchanged.

    Only digests are shuffled, so the comparison costs the same for long texts.
    """

    def digests(documents, name):
        return documents.select("file_name", F.sha2(F.col("body"), 256).alias(name))

    both = digests(expected, "wanted").join(digests(present, "found"), "file_name", "full_outer")
    change = (
        F.when(F.col("wanted").isNull(), "removed")
        .when(F.col("wanted").eqNullSafe(F.col("found")), "unchanged")
        .otherwise("written")
    )
    return both.select("file_name", change.alias("change"))


def corpus_diff_counts(diff: DataFrame) -> DataFrame:
    """One row: files that should exist, written, removed."""
    return diff.agg(
        F.count_if(F.col("change") != "removed").alias("files"),
        F.count_if(F.col("change") == "written").alias("written"),
        F.count_if(F.col("change") == "removed").alias("removed"),
    )
