"""One row per post: the last arrival wins."""

from pyspark.sql import DataFrame, Window, functions as F

from postlake.operators.decode import ARRIVAL
from postlake.schemas import POST_COLUMNS


def dedupe_last(batch: DataFrame) -> DataFrame:
    """Keep the last arrival of each post_id; should two arrive at the same place, the
    choice goes by their content, so that it is the same in every run.

    The row_number filter becomes a group limit, so each task keeps one row per post
    before the shuffle and a post repeated millions of times sends one row per task.
    """
    last_first = Window.partitionBy("post_id").orderBy(
        *[F.desc(c) for c in ARRIVAL], F.desc(F.xxhash64(*POST_COLUMNS))
    )
    return (
        batch.withColumn("nth", F.row_number().over(last_first))
        .where(F.col("nth") == 1)
        .select(*POST_COLUMNS)
    )
