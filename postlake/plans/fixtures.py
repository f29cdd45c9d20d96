"""Views over the given tables that stand in for an archive and its inputs."""

import os

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from postlake.operators.corpus import render_body
from postlake.operators.textindex import TextIndex, build_postings, read_index, write_index
from postlake.schemas import POST_COLUMNS
from postlake.session import scratch_path, shuffles_removed

POSTS_SQL = """
SELECT CAST(doc_id AS STRING) AS post_id, text AS content,
  CASE WHEN doc_id % 97 = 0 THEN NULL
       ELSE TIMESTAMP_NTZ '2025-09-01 00:00:00'
            + (doc_id - doc_id % 2) * INTERVAL '37' MINUTE END AS created_at,
  CAST((doc_id * 7919) % 3256 AS BIGINT)  AS like_count,
  CAST((doc_id * 104729) % 301 AS BIGINT) AS repost_count,
  CAST((doc_id * 31) % 53 AS BIGINT)      AS reply_count,
  CAST(CASE WHEN doc_id % 13 = 0 THEN NULL
            ELSE (doc_id * 15485863) % 50021 END AS BIGINT) AS view_count,
  CASE WHEN doc_id % 4 = 1 THEN 1 ELSE 0 END  AS is_reply,
  CASE WHEN doc_id % 10 = 3 THEN 1 ELSE 0 END AS is_repost,
  CASE WHEN doc_id % 7 = 0 THEN 1 ELSE 0 END  AS is_quote,
  CASE WHEN doc_id % 4 = 1 THEN CAST(doc_id - 1 AS STRING) END AS reply_to_post_id,
  doc_id, lang, source
FROM {documents}
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def numbered_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts with the doc_id, lang and source they were made from."""
    return spark.sql(POSTS_SQL, documents=table(spark, sf_dir, "documents"))


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return numbered_posts(spark, sf_dir).select(*POST_COLUMNS)


def text_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbered posts for work on the texts. A table that gives fewer tasks than there are
    cores is spread over the cores first, wherever it is stored."""
    rows = numbered_posts(spark, sf_dir)
    cores = spark.sparkContext.defaultParallelism
    return rows.repartition(cores) if rows.rdd.getNumPartitions() < cores else rows


_indexes: dict = {}


def text_index(spark: SparkSession, sf_dir: str, fields=("content",)) -> TextIndex:
    """The stored index of all posts, as searches read it. It is built by the first search of
    a session over these tables, in the shared folder, and read back by all."""
    key = (spark.sparkContext.applicationId, sf_dir, tuple(fields))
    if key not in _indexes:
        rows, path = text_posts(spark, sf_dir), scratch_path(spark, "posts-index")
        write_index(build_postings(rows, fields, fold=False), rows, path, fields=fields, fold=False)
        _indexes[key] = path
    return read_index(spark, _indexes[key])


def archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return numbered_posts(spark, sf_dir).where("doc_id % 5 <> 4").select(*POST_COLUMNS)


def incoming(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = numbered_posts(spark, sf_dir)
    again = rows.where("doc_id % 3 = 0").withColumn(
        "like_count", F.expr("CASE WHEN doc_id % 2 = 0 THEN like_count + 1 ELSE like_count END")
    )
    new = rows.where("doc_id % 17 = 0").withColumns(
        {
            "post_id": F.expr("CAST(doc_id + 1000000 AS STRING)"),
            "created_at": F.expr("created_at + INTERVAL '400' DAY"),
        }
    )
    return again.unionByName(new).select(*POST_COLUMNS)


def raw_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(sequence, chunk, pos, item_json): every post, then a fifth of them again, newer."""
    rows = text_posts(spark, sf_dir)
    first = rows.withColumn("sequence", F.lit(0).cast("bigint"))
    second = rows.where("doc_id % 5 = 0").withColumns(
        {"sequence": F.lit(1).cast("bigint"), "like_count": F.col("like_count") + 1}
    )
    both = first.unionByName(second)
    return both.select(
        "sequence", F.lit(0).alias("chunk"), F.col("doc_id").cast("int").alias("pos"),
        _item().alias("item_json"),
    )


def _item() -> Column:
    text = F.expr("CASE WHEN doc_id % 20 = 13 THEN concat('RT @x: ', content) ELSE content END")
    is_long = F.col("doc_id") % 6 == 0
    legacy = F.struct(
        F.expr("CASE WHEN doc_id % 8 = 0 THEN post_id ELSE '' END").alias("id_str"),
        F.when(is_long, F.substring(text, 1, 140)).otherwise(text).alias("full_text"),
        F.expr(
            "CASE WHEN created_at IS NOT NULL THEN concat("
            "element_at(array('Sun','Mon','Tue','Wed','Thu','Fri','Sat'), dayofweek(created_at)),"
            "' ', date_format(created_at, 'MMM dd HH:mm:ss'), ' +0000 ', date_format(created_at, 'yyyy')) END"
        ).alias("created_at"),
        F.col("like_count").alias("favorite_count"),
        F.col("repost_count").alias("retweet_count"),
        "reply_count",
        F.col("reply_to_post_id").alias("in_reply_to_status_id_str"),
        (F.col("is_quote") == 1).alias("is_quote_status"),
    )
    embedded = F.when(F.expr("doc_id % 20 = 3"), F.lit('{"rest_id":"1"}')).when(
        F.expr("doc_id % 9 = 0 AND is_repost = 0"), F.lit("{}")
    )
    # The embedded original is put into the text, since a struct cannot be an empty object.
    legacy_json = F.when(
        embedded.isNotNull(),
        F.concat(
            F.regexp_replace(F.to_json(legacy), r"\}$", ""),
            F.lit(',"retweeted_status_result":'), embedded, F.lit("}"),
        ),
    ).otherwise(F.to_json(legacy))
    outer = F.to_json(
        F.struct(
            F.expr("CASE WHEN doc_id % 8 = 0 THEN '' ELSE post_id END").alias("rest_id"),
            F.when(
                is_long,
                F.struct(F.struct(F.struct(text.alias("text")).alias("result")).alias("note_tweet_results")),
            ).alias("note_tweet"),
            F.when(
                F.col("view_count").isNotNull(), F.struct(F.col("view_count").cast("string").alias("count"))
            ).alias("views"),
        )
    )
    payload = F.concat(
        F.lit(',"payload":'), F.regexp_replace(outer, r"\}$", ""), F.lit(',"legacy":'), legacy_json, F.lit("}")
    )
    return F.concat(
        F.lit('{"id":"item-'), F.col("post_id"), F.lit('"'),
        F.when(F.expr("doc_id % 11 = 0"), F.lit("")).otherwise(payload),
        F.lit("}"),
    )


def later_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items of a later job, whose sequences begin at 0 again: some posts with more likes."""
    rows = text_posts(spark, sf_dir).where("doc_id % 4 = 1").withColumn("like_count", F.col("like_count") + 5)
    return rows.select(
        F.lit(0).cast("bigint").alias("sequence"), F.lit(0).alias("chunk"), F.col("doc_id").cast("int").alias("pos"),
        _item().alias("item_json"),
    )


def envelopes(items: DataFrame) -> DataFrame:
    """One JSON envelope per page of 100 items, in a single text column."""
    page = F.floor(F.col("pos") / 100)
    pages = (
        items
        .groupBy("sequence", page.alias("page"))
        .agg(F.sort_array(F.collect_list(F.struct("pos", "item_json"))).alias("items"))
    )
    items = F.array_join(F.transform("items", lambda i: i["item_json"]), ",")
    return pages.select(
        F.concat(
            F.lit('{"ok":true,"data":{"result":{"chunks":[{"sequence":'),
            F.col("sequence").cast("string"),
            F.lit(',"items":['), items, F.lit("]}]}}}"),
        ).alias("value")
    )


def write_dump(items: DataFrame, path: str) -> None:
    """Envelopes of items as the text files of a dump, compressed as dumps are sent."""
    with shuffles_removed(items.sparkSession):
        envelopes(items).write.text(path, compression="gzip")


def corpus_present(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(file_name, body) of a corpus that is partly missing, stale and left over."""
    rows = numbered_posts(spark, sf_dir)
    kept = rows.where("doc_id % 12 <> 0").withColumn(
        "like_count", F.expr("CASE WHEN doc_id % 15 = 1 THEN like_count + 1 ELSE like_count END")
    )
    left_over = rows.where("doc_id % 50 = 0").withColumn("post_id", F.expr("CAST(doc_id + 2000000 AS STRING)"))
    return render_body(kept.unionByName(left_over)).select("file_name", "body")


def hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(path, post_id, score, snippet) as a search over rendered files would give them."""
    return table(spark, sf_dir, "pages").selectExpr(
        "concat(CAST(page_id * 5 AS STRING), '.txt') AS path",
        "CAST(page_id * 5 AS STRING) AS post_id",
        "CAST(1.0 AS DOUBLE) / (1 + page_id) AS score",
        "html AS snippet",
    )


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").selectExpr("CAST(vec_id * 3 AS STRING) AS post_id", "embedding")


def query_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every twentieth vector asks for its neighbours among all."""
    return table(spark, sf_dir, "embeddings").where("vec_id % 20 = 0").selectExpr(
        "concat('q', CAST(vec_id AS STRING)) AS query_id", "embedding"
    )
