"""Top-n lists, overall and per query. A negative n means every row."""

from pyspark.sql import DataFrame, Window, functions as F

from postlake.session import stage

METRICS = {"likes": "like_count", "reposts": "repost_count", "views": "view_count"}


def ordered(posts: DataFrame, column: str) -> DataFrame:
    """Highest first, missing values last, ties by post_id."""
    return posts.orderBy(F.col(column).desc_nulls_last(), F.col("post_id"))


def take(rows: DataFrame, n: int) -> DataFrame:
    return rows if n < 0 else rows.limit(n)


def top(posts: DataFrame, metric: str = "likes", n: int = 10) -> DataFrame:
    """Posts that are no reposts with the most likes, reposts or views."""
    shown = posts.where(F.col("is_repost") == 0).select(
        "post_id", "created_at", "content", "like_count", "repost_count", "view_count"
    )
    return take(ordered(shown, METRICS.get(metric, "like_count")), n)


def recent(posts: DataFrame, n: int = 10) -> DataFrame:
    """Newest posts that are no reposts."""
    shown = posts.where(F.col("is_repost") == 0).select(
        "post_id", "created_at", "content", "like_count", "view_count"
    )
    return take(ordered(shown, "created_at"), n)


def best_first():
    return [F.col("score").desc(), F.col("post_id").asc()]


def all_ranks(hits: DataFrame) -> DataFrame:
    """Hits with their rank in whole rankings: rows are laid out in order over many
    partitions, counted per partition, and numbered inside it. The layout is written first,
    so that counting and numbering see the same one."""
    order = [F.col("query_id"), *best_first()]
    laid_out = stage(
        hits.repartitionByRange(*order).withColumn("stretch", F.spark_partition_id()), "ranking"
    )
    before = Window.partitionBy("query_id").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        laid_out.groupBy("query_id", "stretch").agg(F.count("*").alias("n"))
        .select("query_id", "stretch", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    )
    inside = Window.partitionBy("query_id", "stretch").orderBy(*best_first())
    return (
        laid_out.withColumn("nth", F.row_number().over(inside))
        .join(offsets, ["query_id", "stretch"])
        .select(*hits.columns, (F.col("nth") + F.col("offset")).cast("int").alias("rank"))
    )


def topk(hits: DataFrame, n: int) -> DataFrame:
    """The best n hits of each query with their rank; every hit for n < 0.

    Up to a limit set in Spark (1000 by default) each task cuts its own hits to n per
    query before the shuffle. Beyond it, and for n < 0, whole rankings are laid out over
    many tasks, so that no task ever sorts all hits of one query; that runs a job.
    """
    limit = int(hits.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    if n < 0 or n > limit:
        ranked = all_ranks(hits)
        return ranked if n < 0 else ranked.where(F.col("rank") <= n)
    per_query = Window.partitionBy("query_id").orderBy(*best_first())
    return hits.withColumn("rank", F.row_number().over(per_query)).where(F.col("rank") <= n)
