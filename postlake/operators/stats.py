"""Archive and batch figures. Each is one scan with partial aggregation."""

from pyspark.sql import Column, DataFrame, functions as F

from postlake.operators.joins import boundary_seen


def _when_not_repost(column: str) -> Column:
    return F.when(F.col("is_repost") == 0, F.col(column))


def archive_stats(posts: DataFrame) -> DataFrame:
    """One row. The kinds overlap, so they need not add up to the total."""
    return posts.agg(
        F.count("*").alias("total"),
        F.count_if((F.col("is_repost") == 0) & (F.col("is_reply") == 0)).alias("original"),
        F.count_if(F.col("is_reply") == 1).alias("replies"),
        F.count_if(F.col("is_repost") == 1).alias("reposts"),
        F.min("created_at").alias("earliest"),
        F.max("created_at").alias("latest"),
        F.round(F.avg(_when_not_repost("like_count")), 1).alias("avg_likes"),
        F.round(F.avg(_when_not_repost("view_count")), 0).alias("avg_views"),
    )


def archive_summary(posts: DataFrame, *more: Column) -> DataFrame:
    """One row, with more figures of the same scan if given. Unlike in archive_stats, `original`
    is null for an empty archive."""
    return posts.agg(
        F.count("*").alias("total"),
        F.sum(
            F.when((F.col("is_repost") == 0) & (F.col("is_reply") == 0), 1).otherwise(0)
        ).alias("original"),
        F.min("created_at").alias("earliest"),
        F.max("created_at").alias("latest"),
        F.round(F.avg(_when_not_repost("like_count")), 1).alias("avg_likes"),
        F.round(F.avg(_when_not_repost("view_count")), 0).alias("avg_views"),
        *more,
    )


def archive_latest(posts: DataFrame) -> DataFrame:
    return posts.agg(F.max("created_at").alias("latest"))


def batch_summary(batch: DataFrame, archive: DataFrame) -> DataFrame:
    """One row per batch: rows, newest, oldest and whether it reaches the archive."""
    return batch.agg(
        F.count("*").alias("n_posts"),
        F.max("created_at").alias("newest"),
        F.min("created_at").alias("oldest"),
    ).withColumn("overlaps", boundary_seen(batch, archive).scalar())


def change_counts(classified: DataFrame) -> DataFrame:
    """(change, n_rows) for the classes present."""
    return classified.groupBy("change").agg(F.count("*").alias("n_rows"))
