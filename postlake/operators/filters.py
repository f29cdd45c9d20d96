"""Row filters over posts."""

from pyspark.sql import DataFrame, functions as F

from postlake.functions.text import escape_like
from postlake.operators.ranking import ordered, take

_KINDS = {
    "original": lambda: (F.col("is_repost") == 0) & (F.col("is_reply") == 0),
    "reply": lambda: F.col("is_reply") == 1,
    "repost": lambda: F.col("is_repost") == 1,
    "not_repost": lambda: F.col("is_repost") == 0,
}


def filter_kind(posts: DataFrame, kind: str) -> DataFrame:
    """original, reply, repost or not_repost. Replies may be reposts too."""
    return posts.where(_KINDS[kind]())


def filter_min(posts: DataFrame, metric: str, n: int) -> DataFrame:
    """Posts whose metric is above n, highest first."""
    return ordered(posts.where(F.col(metric) > n), metric)


def filter_contains(posts: DataFrame, text: str, n: int = 10) -> DataFrame:
    """Posts containing the text whatever its case, most liked first."""
    found = posts.where(F.col("content").ilike(f"%{escape_like(text)}%"))
    return take(ordered(found, "like_count"), n)
