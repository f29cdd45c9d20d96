"""Declared schemas. Nothing in this package infers a schema."""

from pyspark.sql import types as T

POSTS = T.StructType(
    [
        T.StructField("post_id", T.StringType()),
        T.StructField("content", T.StringType()),
        T.StructField("created_at", T.TimestampNTZType()),
        T.StructField("like_count", T.LongType()),
        T.StructField("repost_count", T.LongType()),
        T.StructField("reply_count", T.LongType()),
        T.StructField("view_count", T.LongType()),
        T.StructField("is_reply", T.IntegerType()),
        T.StructField("is_repost", T.IntegerType()),
        T.StructField("is_quote", T.IntegerType()),
        T.StructField("reply_to_post_id", T.StringType()),
    ]
)

POST_COLUMNS = POSTS.fieldNames()

# Everything an update compares and overwrites: all columns but the key.
VALUE_COLUMNS = [c for c in POST_COLUMNS if c != "post_id"]

POSTINGS = T.StructType(
    [
        T.StructField("term", T.StringType()),
        T.StructField("field", T.StringType()),
        T.StructField("post_id", T.StringType()),
        T.StructField("tf", T.IntegerType()),
        T.StructField("doc_len", T.IntegerType()),
        T.StructField("lead", T.BooleanType()),
        T.StructField("positions", T.ArrayType(T.IntegerType())),
    ]
)

CORPUS = T.StructType(
    [
        T.StructField("post_id", T.StringType()),
        T.StructField("file_name", T.StringType()),
        T.StructField("body", T.StringType()),
    ]
)

# One row per query unit: a word, phrase, prefix, proximity group or post start.
UNITS = T.StructType(
    [
        T.StructField("query_id", T.StringType()),
        T.StructField("unit", T.IntegerType()),
        T.StructField("clause", T.IntegerType()),
        T.StructField("negated", T.BooleanType()),
        T.StructField("kind", T.StringType()),
        T.StructField("words", T.ArrayType(T.StringType())),
        T.StructField("near_k", T.IntegerType()),
        T.StructField("field", T.StringType()),
    ]
)
