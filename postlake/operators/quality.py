"""Data checks before an archive is published."""

from pyspark.sql import DataFrame, functions as F

COUNTS = ["like_count", "repost_count", "reply_count", "view_count"]
FLAGS = ["is_reply", "is_repost", "is_quote"]


def archive_check(posts: DataFrame) -> DataFrame:
    """(rule, n_bad) for every rule, also those without a fault.

    Row rules are one scan. Repeated ids are counted after a partial count per task, so
    an id repeated millions of times does not burden one task.
    """
    bad_flag = F.lit(False)
    for flag in FLAGS:
        bad_flag = bad_flag | ~F.coalesce(F.col(flag).isin(0, 1), F.lit(False))
    bad_count = F.lit(False)
    for count in COUNTS:
        bad_count = bad_count | F.coalesce(F.col(count) < 0, F.lit(False))
    no_target = (F.col("is_reply") == 1) & (F.coalesce("reply_to_post_id", F.lit("")) == "")
    rules = {
        "null_id": F.col("post_id").isNull() | (F.col("post_id") == ""),
        "flag_not_0_or_1": bad_flag,
        "negative_count": bad_count,
        "reply_without_target": no_target,
    }
    by_row = posts.agg(*[F.count_if(rule).alias(name) for name, rule in rules.items()])
    by_row = by_row.unpivot([], list(rules), "rule", "n_bad")
    repeated = (
        posts.where(F.col("post_id").isNotNull())
        .groupBy("post_id").agg(F.count("*").alias("n"))
        .where(F.col("n") > 1)
        .agg(F.lit("duplicate_id").alias("rule"), F.count("*").alias("n_bad"))
    )
    return by_row.unionByName(repeated)
