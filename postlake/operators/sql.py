"""Spark SQL over the archive and its index."""

from pyspark.sql import DataFrame, SparkSession

from postlake.operators.textindex import live_postings


def register_views(posts: DataFrame, index=None) -> None:
    """Name the frames `posts`, `postings` and `term_stats` for SQL."""
    posts.createOrReplaceTempView("posts")
    if index is not None:
        live_postings(index).createOrReplaceTempView("postings")
        index.term_stats.createOrReplaceTempView("term_stats")


def run_sql(spark: SparkSession, query: str) -> DataFrame:
    """Run one query. Wrapped as a subquery, a statement that changes anything is refused."""
    return spark.sql(f"SELECT * FROM (\n{query.strip().rstrip(';')}\n)")
