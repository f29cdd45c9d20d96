"""Decoding raw items into posts."""

from pyspark.sql import Column, DataFrame, functions as F

from postlake.functions import text, times, variants
from postlake.schemas import POST_COLUMNS, POSTS

# The parts of an item that are read. Leaves are VARIANT so that one pass
# over the JSON keeps their types; a payload or legacy part that is no object is null.
ITEM = (
    "id variant, payload struct<"
    "rest_id: variant, "
    "note_tweet: struct<note_tweet_results: struct<result: struct<text: variant>>>, "
    "views: struct<count: variant>, "
    "legacy: struct<id_str: variant, full_text: variant, text: variant, created_at: variant, "
    "favorite_count: variant, retweet_count: variant, reply_count: variant, "
    "in_reply_to_status_id_str: variant, is_quote_status: variant, "
    "retweeted_status_result: variant>>"
)

LEAVES = {
    "rest_id": "payload.rest_id",
    "id_str": "payload.legacy.id_str",
    "item_id": "id",
    "note": "payload.note_tweet.note_tweet_results.result.text",
    "full_text": "payload.legacy.full_text",
    "short_text": "payload.legacy.text",
    "time": "payload.legacy.created_at",
    "likes": "payload.legacy.favorite_count",
    "reposts": "payload.legacy.retweet_count",
    "replies": "payload.legacy.reply_count",
    "views": "payload.views.count",
    "reply_to": "payload.legacy.in_reply_to_status_id_str",
    "quote": "payload.legacy.is_quote_status",
    "original": "payload.legacy.retweeted_status_result",
}

# Sequences count inside one job, jobs sort by age.
ARRIVAL = ["job", "sequence", "chunk", "pos"]


def parse_items(raw: DataFrame) -> DataFrame:
    """The leaves of items whose payload and legacy part are objects and that have an id.

    Each item is parsed once. The leaves pass through an explode of one element, because
    filters are not moved below it, where they would parse each item again.
    """
    if "job" not in raw.columns:
        raw = raw.withColumn("job", F.lit(""))
    parsed = F.from_json("item_json", ITEM)
    one = F.explode(F.filter(F.array(parsed), lambda item: item["payload"]["legacy"].isNotNull()))
    leaves = F.struct(*[
        variants.leaf(F.col(f"item.{path}")).alias(name) for name, path in LEAVES.items()
    ])
    return (
        raw.select(*ARRIVAL, "item_json", one.alias("item"))
        .select(*ARRIVAL, "item_json", F.explode(F.array(leaves)).alias("leaf"))
        .select(*ARRIVAL, "item_json", "leaf.*")
        .withColumn("post_id", post_id_of_item())
        .where(F.col("post_id").isNotNull())
    )


def post_id_of_item() -> Column:
    return F.coalesce(*[variants.truthy_text(F.col(c)) for c in ("rest_id", "id_str", "item_id")])


def content_of_item() -> Column:
    """Long text if it is a text and not blank, else the full text, else the short one."""
    long_form = F.when(variants.is_text(F.col("note")), text.strip(F.col("note.text")))
    short_form = F.coalesce(
        variants.truthy_text(F.col("full_text")), variants.truthy_text(F.col("short_text")), F.lit("")
    )
    return F.when(long_form != "", long_form).otherwise(text.strip(short_form))


def decode_rows(raw: DataFrame) -> DataFrame:
    """Arrival columns, post columns and `problem`, which is null for a readable row."""
    time, reply_to = F.col("time"), F.col("reply_to")
    rows = parse_items(raw).select(
        *ARRIVAL,
        "item_json",
        "post_id",
        content_of_item().alias("content"),
        variants.is_truthy(time).alias("has_time"),
        times.parse_post_time(F.when(variants.is_text(time), time["text"])).alias("created_at"),
        variants.whole_number(F.col("likes")).alias("like_count"),
        variants.whole_number(F.col("reposts")).alias("repost_count"),
        variants.whole_number(F.col("replies")).alias("reply_count"),
        variants.whole_number(F.col("views")).alias("view_count"),
        variants.is_truthy(reply_to).cast("int").alias("is_reply"),
        variants.is_truthy(F.col("original")).alias("embeds_original"),
        variants.is_truthy(F.col("quote")).cast("int").alias("is_quote"),
        variants.truthy_text(reply_to).alias("reply_to_post_id"),
    )
    problem = F.when(F.col("has_time") & F.col("created_at").isNull(), "created_at")
    for count in ["like_count", "repost_count", "reply_count", "view_count"]:
        problem = problem.when(F.col(count).isNull(), count)
    is_repost = (F.col("embeds_original") | F.col("content").startswith("RT @")).cast("int")
    return rows.withColumns({"is_repost": is_repost, "problem": problem})


def decode_items(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(posts with their arrival columns, rejects with the column that is unreadable)."""
    return split_rows(decode_rows(raw))


def split_rows(rows: DataFrame, *also: str) -> tuple[DataFrame, DataFrame]:
    posts = rows.where(F.col("problem").isNull()).select(
        *ARRIVAL, *[F.col(c).cast(POSTS[c].dataType) for c in POST_COLUMNS], *also
    )
    rejects = rows.where(F.col("problem").isNotNull()).select(*ARRIVAL, "post_id", "problem", "item_json")
    return posts, rejects
