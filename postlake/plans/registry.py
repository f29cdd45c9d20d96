"""Every operator as a query over the given tables: name -> (spark, sf_dir) -> DataFrame.

Times leave as ISO text and arrays as joined text, so that results compare across engines.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

import postlake as P
from postlake.functions.times import day_text, time_text
from postlake.operators.decode import parse_items
from postlake.plans import fixtures as X
from postlake.session import scratch_path

QUERIES = {}

# Words in fewer than half of the documents, and one (`the`) in more.
SEARCH_SCHEMA = T.StructType(
    [T.StructField("query_id", T.StringType())]
    + [
        T.StructField(name, T.ArrayType(T.StringType()))
        for name in ("must", "should", "must_not", "phrase", "prefix", "near", "initial")
    ]
    + [T.StructField("near_k", T.IntegerType()), T.StructField("field", T.StringType())]
)


def query(function):
    QUERIES[function.__name__] = function
    return function


def search_table(spark: SparkSession, *rows: dict) -> DataFrame:
    names = SEARCH_SCHEMA.fieldNames()
    return spark.createDataFrame([tuple(row.get(name) for name in names) for row in rows], SEARCH_SCHEMA)


def shown(posts: DataFrame) -> DataFrame:
    """Posts with times as text and the content as a digest."""
    return posts.select(
        *[c for c in posts.columns if c not in ("created_at", "content")],
        time_text(F.col("created_at")).alias("created_at"),
        F.md5("content").alias("content_md5"),
    )


def decoded(spark, sf_dir) -> DataFrame:
    return P.decode_items(X.raw_items(spark, sf_dir))[0]


# --- sources and sinks ---------------------------------------------------------------


@query
def scan_archive(spark, sf_dir):
    path = scratch_path(spark, "archive")
    P.write_posts(X.posts(spark, sf_dir), path, "v1", clustered=True)
    return P.read_posts(spark, path).select("post_id", "like_count", "view_count", "is_reply")


@query
def scan_raw_items(spark, sf_dir):
    path = scratch_path(spark, "dump")
    X.envelopes(X.raw_items(spark, sf_dir)).write.text(path)
    return P.read_raw_items(spark, path).select(
        "sequence", F.get_json_object("item_json", "$.id").alias("item_id"),
        F.get_json_object("item_json", "$.payload.rest_id").alias("rest_id"),
    )


@query
def scan_corpus_text(spark, sf_dir):
    path = scratch_path(spark, "corpus")
    P.write_corpus(X.posts(spark, sf_dir), path)
    return P.parse_documents(P.read_rendered(spark, path)).select(
        "post_id", F.coalesce(F.col("post_date").cast("string"), F.lit("")).alias("post_date"),
        "like_count", F.md5("content").alias("content_md5"),
    )


@query
def write_archive(spark, sf_dir):
    path = scratch_path(spark, "archive")
    P.write_posts(X.archive(spark, sf_dir), path, "v1", clustered=True)
    P.write_changes(spark, path, "v2", X.incoming(spark, sf_dir))
    return shown(P.read_posts(spark, path))


@query
def write_corpus(spark, sf_dir):
    path = scratch_path(spark, "corpus")
    P.write_corpus(X.posts(spark, sf_dir), path)
    return P.read_rendered(spark, path).select("post_id", "file_name", F.md5("body").alias("body_md5"))


@query
def rows_to_json(spark, sf_dir):
    return P.to_json_rows(
        X.posts(spark, sf_dir).select(
            "post_id", "content", time_text(F.col("created_at")).alias("created_at"),
            "like_count", "view_count", "reply_to_post_id",
        )
    )


# --- decoding ------------------------------------------------------------------------


@query
def decode_items(spark, sf_dir):
    return shown(decoded(spark, sf_dir).drop("job", "chunk", "pos"))


@query
def post_id_chain(spark, sf_dir):
    return parse_items(X.raw_items(spark, sf_dir)).select("sequence", "post_id")


@query
def choose_text(spark, sf_dir):
    return decoded(spark, sf_dir).select(
        "sequence", "post_id", F.length("content").alias("n_chars"), F.md5("content").alias("content_md5")
    )


@query
def parse_created_at(spark, sf_dir):
    return decoded(spark, sf_dir).select("sequence", "post_id", time_text(F.col("created_at")).alias("created_at"))


@query
def engagement_counts(spark, sf_dir):
    return decoded(spark, sf_dir).select(
        "sequence", "post_id", "like_count", "repost_count", "reply_count", "view_count"
    )


@query
def post_flags(spark, sf_dir):
    return decoded(spark, sf_dir).select(
        "sequence", "post_id", "is_reply", "is_repost", "is_quote", "reply_to_post_id"
    )


@query
def strip_markup(spark, sf_dir):
    return P.strip_markup(X.table(spark, sf_dir, "pages"), "html").select("page_id", "url", F.col("html").alias("text"))


@query
def render_body(spark, sf_dir):
    return P.render_body(X.posts(spark, sf_dir)).select("post_id", "file_name", "body")


# --- filters -------------------------------------------------------------------------


@query
def filter_kind(spark, sf_dir):
    posts = X.posts(spark, sf_dir)
    kinds = [
        P.filter_kind(posts, kind).select(F.lit(kind).alias("kind"), "post_id")
        for kind in ("original", "reply", "repost", "not_repost")
    ]
    return kinds[0].union(kinds[1]).union(kinds[2]).union(kinds[3])


@query
def filter_min_metric(spark, sf_dir):
    return P.filter_min(X.posts(spark, sf_dir), "like_count", 500).select("post_id", "like_count")


@query
def filter_contains(spark, sf_dir):
    return P.filter_contains(X.posts(spark, sf_dir), "TION the", 20).select("post_id", "like_count")


# --- joins ---------------------------------------------------------------------------


@query
def hits_join_posts(spark, sf_dir):
    joined = P.join_hits(X.hits(spark, sf_dir), X.posts(spark, sf_dir))
    return shown(joined.select("path", "post_id", "score", "created_at", "content", "like_count", "view_count"))


@query
def enrich_hits(spark, sf_dir):
    rows = P.enrich_hits(X.hits(spark, sf_dir), X.posts(spark, sf_dir))
    return rows.withColumn("content_md5", F.md5("content")).drop("content")


@query
def lookup_ids(spark, sf_dir):
    return P.lookup_ids(X.posts(spark, sf_dir), X.hits(spark, sf_dir)).select("post_id", "like_count")


@query
def boundary_seen(spark, sf_dir):
    return P.boundary_seen(X.incoming(spark, sf_dir), X.archive(spark, sf_dir))


@query
def classify_changes(spark, sf_dir):
    return P.classify_changes(X.incoming(spark, sf_dir), X.archive(spark, sf_dir)).select(
        "post_id", "like_count", "change"
    )


@query
def late_filter(spark, sf_dir):
    kept, late = P.late_filter(X.incoming(spark, sf_dir), X.archive(spark, sf_dir))
    return kept.select("post_id", F.lit("kept").alias("outcome")).union(
        late.select("post_id", F.lit("late").alias("outcome"))
    )


@query
def corpus_diff(spark, sf_dir):
    return P.corpus_diff(P.render_body(X.posts(spark, sf_dir)), X.corpus_present(spark, sf_dir))


# --- aggregates ----------------------------------------------------------------------


def _times_as_text(row: DataFrame, *names) -> DataFrame:
    return row.withColumns({name: time_text(F.col(name)) for name in names})


@query
def archive_stats(spark, sf_dir):
    return _times_as_text(P.archive_stats(X.posts(spark, sf_dir)), "earliest", "latest")


@query
def archive_summary(spark, sf_dir):
    return _times_as_text(P.archive_summary(X.posts(spark, sf_dir)), "earliest", "latest")


@query
def archive_latest(spark, sf_dir):
    return _times_as_text(P.archive_latest(X.posts(spark, sf_dir)), "latest")


@query
def batch_summary(spark, sf_dir):
    row = P.batch_summary(X.incoming(spark, sf_dir), X.archive(spark, sf_dir))
    return _times_as_text(row, "newest", "oldest")


@query
def change_counts(spark, sf_dir):
    incoming, archive = X.incoming(spark, sf_dir), X.archive(spark, sf_dir)
    kept, late = P.late_filter(incoming, archive)
    changes = P.classify_changes(kept, archive).select("change")
    return P.change_counts(changes.union(late.select(F.lit("late").alias("change"))))


@query
def corpus_diff_counts(spark, sf_dir):
    return P.corpus_diff_counts(corpus_diff(spark, sf_dir))


# --- windows and top-n ---------------------------------------------------------------


@query
def dedupe_last_wins(spark, sf_dir):
    """Two dumps of one day: the sequences of the later one begin at 0 again."""
    dump = scratch_path(spark, "dump")
    for name, items in (("job-a", X.raw_items(spark, sf_dir)), ("job-b", X.later_items(spark, sf_dir))):
        X.envelopes(items).write.text(f"{dump}/2025-09-29/{name}")
    return shown(P.dedupe_last(P.decode_items(P.read_raw_items(spark, f"{dump}/2025-09-29/*"))[0]))


@query
def topk_per_query(spark, sf_dir):
    scored = X.numbered_posts(spark, sf_dir).select(
        F.concat("source", F.lit("/"), "lang").alias("query_id"), "post_id",
        F.col("like_count").cast("double").alias("score"),
    )
    return P.topk(scored, 3)


@query
def top_likes(spark, sf_dir):
    return shown(P.top(X.posts(spark, sf_dir), "likes", 10))


@query
def top_reposts(spark, sf_dir):
    return shown(P.top(X.posts(spark, sf_dir), "reposts", 10))


@query
def top_views(spark, sf_dir):
    return shown(P.top(X.posts(spark, sf_dir), "views", 10))


@query
def recent_posts(spark, sf_dir):
    return shown(P.recent(X.posts(spark, sf_dir), 10))


# --- text index and search -----------------------------------------------------------


@query
def tokenize_posts(spark, sf_dir):
    return P.tokenize(X.text_posts(spark, sf_dir))


@query
def build_postings(spark, sf_dir):
    return _postings_as_text(P.build_postings(X.text_posts(spark, sf_dir), fold=False))


def _postings_as_text(postings: DataFrame) -> DataFrame:
    return postings.select(
        "term", "field", "post_id", "tf", "doc_len", "lead",
        F.array_join(F.transform("positions", lambda p: p.cast("string")), ",").alias("positions"),
    )


@query
def term_stats(spark, sf_dir):
    posts = X.text_posts(spark, sf_dir)
    stats = P.term_stats(P.build_postings(posts, fold=False)).select("term", "df")
    totals = P.index_totals(P.doc_stats(posts, fold=False)).select(F.struct("*").alias("t")).scalar()
    return stats.withColumn("n_docs", totals["n_docs"]).withColumn(
        "avg_len", F.round(totals["n_tokens"] / totals["n_docs"], 4)
    )


@query
def keyword_search(spark, sf_dir):
    posts = X.posts(spark, sf_dir)
    queries = search_table(
        spark,
        {"query_id": "two words", "must": ["from", "by"]},
        {"query_id": "one word", "must": ["tion"]},
        {"query_id": "common", "must": ["the"]},
        {"query_id": "none", "must": ["from", "zzzzz"]},
    )
    hits = P.search(queries, X.text_index(spark, sf_dir), 10)
    joined = P.join_hits(hits, posts, max_hits=4 * 10)
    return joined.select("query_id", "rank", "post_id", "score", "like_count", day_text(F.col("created_at")).alias("day"))


@query
def boolean_search(spark, sf_dir):
    queries = search_table(
        spark,
        {"query_id": "or", "should": ["tion", "ed", "zzzzz"]},
        {"query_id": "and or not", "must": ["from"], "should": ["tion", "by"], "must_not": ["ed"]},
        {"query_id": "not", "must": ["nd"], "must_not": ["the", "of"]},
    )
    return P.search(queries, X.text_index(spark, sf_dir), 10)


@query
def phrase_search(spark, sf_dir):
    queries = search_table(
        spark,
        {"query_id": "two", "phrase": ["of", "the"]},
        {"query_id": "three", "phrase": ["to", "the", "of"]},
        {"query_id": "with word", "must": ["in the", "from"]},
    )
    return P.search(queries, X.text_index(spark, sf_dir), 10)


@query
def prefix_search(spark, sf_dir):
    queries = search_table(
        spark,
        {"query_id": "short", "prefix": ["fro"]},
        {"query_id": "long", "prefix": ["thatth"]},
        {"query_id": "with word", "must": ["by"], "prefix": ["tio"]},
    )
    return P.search(queries, X.text_index(spark, sf_dir), 10)


@query
def near_search(spark, sf_dir):
    queries = search_table(
        spark,
        {"query_id": "close", "near": ["from", "by"], "near_k": 3},
        {"query_id": "default", "near": ["tion", "nd"]},
        {"query_id": "three", "near": ["from", "by", "ed"], "near_k": 20},
    )
    return P.search(queries, X.text_index(spark, sf_dir), 10)


@query
def initial_search(spark, sf_dir):
    queries = search_table(
        spark, {"query_id": "the", "initial": ["the"]}, {"query_id": "of", "initial": ["of"]},
        {"query_id": "phrase", "initial": ["of the"]},
    )
    return P.search(queries, X.text_index(spark, sf_dir), 10)


@query
def field_search(spark, sf_dir):
    queries = search_table(
        spark,
        {"query_id": "language", "must": ["de"], "field": "lang"},
        {"query_id": "content", "must": ["de"], "field": "content"},
        {"query_id": "any", "must": ["de"]},
    )
    return P.search(queries, X.text_index(spark, sf_dir, ("content", "lang")), 10)


@query
def benchmark_search(spark, sf_dir):
    """Every benchmark text as one phrase: posts that quote it whole, some two thousand words asked."""
    items = X.table(spark, sf_dir, "benchmark").select(
        F.concat(F.lit("item"), F.col("item_id").cast("string")).alias("query_id"), F.array("text").alias("phrase")
    )
    return P.search(items, X.text_index(spark, sf_dir), 10)


@query
def vector_search(spark, sf_dir):
    return P.vector_search(X.query_vectors(spark, sf_dir), X.vectors(spark, sf_dir), 10)


#: Words asked for beside the query vectors, in turn; one is in no post.
ASKED_WORDS = ["from", "by", "tion", "ed", "nd", "zzzzz", "with"]


def _asked(spark, sf_dir, *words) -> DataFrame:
    """A word for every query vector, and some queries with a word alone."""
    listed = F.array(*[F.lit(w) for w in ASKED_WORDS])
    number = F.floor(F.substring("query_id", 2, 20).cast("bigint") / 20)
    vectors = X.query_vectors(spark, sf_dir).select("query_id", F.array(F.get(listed, number % len(ASKED_WORDS))).alias("must"))
    alone = [(f"w{i}", [w]) for i, w in enumerate(words)]
    return vectors.union(spark.createDataFrame(alone, "query_id string, must array<string>")) if alone else vectors


@query
def hybrid_search(spark, sf_dir):
    keyword = P.search(_asked(spark, sf_dir), X.text_index(spark, sf_dir), -1, shared=True)
    return P.hybrid_search(keyword, X.query_vectors(spark, sf_dir), X.vectors(spark, sf_dir), 10)


@query
def search_fallback(spark, sf_dir):
    keyword = P.search(_asked(spark, sf_dir, "with", "zzzzz"), X.text_index(spark, sf_dir), -1, shared=True)
    return P.search_with_fallback(keyword, X.query_vectors(spark, sf_dir), X.vectors(spark, sf_dir), 5)


@query
def search_all(spark, sf_dir):
    # Every seventh post has left the archive since the index was made.
    posts = X.numbered_posts(spark, sf_dir).where("doc_id % 7 <> 5")
    return P.search_all(
        _asked(spark, sf_dir, "with", "zzzzz"), X.text_index(spark, sf_dir), posts,
        X.query_vectors(spark, sf_dir), X.vectors(spark, sf_dir), 5,
    )


@query
def refresh_postings(spark, sf_dir):
    rows = X.text_posts(spark, sf_dir)
    before = rows.where("doc_id % 5 <> 4")
    after = rows.where("doc_id % 7 <> 3").withColumn(
        "content", F.expr("CASE WHEN doc_id % 6 = 1 THEN concat(content, ' refreshed text') ELSE content END")
    )
    path = scratch_path(spark, "index")
    P.write_index(P.build_postings(before, fold=False), before, path, fold=False)
    # The update as it arrives: posts that are new or changed, and ids that go.
    batch, removed = after.where("doc_id % 6 = 1 OR doc_id % 5 = 4"), before.where("doc_id % 7 = 3").select("post_id")
    P.write_segment(spark, path, *P.index_changes(batch, before, removed))
    return _postings_as_text(P.live_postings(P.read_index(spark, path)))


# --- updates -------------------------------------------------------------------------


@query
def upsert_posts(spark, sf_dir):
    return shown(P.upsert(X.archive(spark, sf_dir), X.incoming(spark, sf_dir)))


@query
def plan_update(spark, sf_dir):
    row = P.plan_update(X.incoming(spark, sf_dir), X.archive(spark, sf_dir))
    return _times_as_text(row, "newest", "oldest", "archive_newest")


@query
def update_report(spark, sf_dir):
    incoming, archive = X.incoming(spark, sf_dir), X.archive(spark, sf_dir)
    after = P.upsert(archive, P.late_filter(incoming, archive)[0])
    corpus = P.corpus_diff_counts(P.corpus_diff(P.render_body(after), P.render_body(archive)))
    report = P.update_report(archive, incoming, after, corpus)
    return report.select(
        "n_posts", "applied", "n_late",
        time_text(F.col("newest")).alias("newest"),
        time_text(F.col("newest_before")).alias("newest_before"),
        "overlaps",
        "db.inserted", "db.updated", "db.unchanged",
        "corpus.files", "corpus.written", "corpus.removed",
        "archive.total", "archive.original", "archive.avg_likes", "archive.avg_views",
        time_text(F.col("archive.latest")).alias("latest"),
    )


@query
def gap_check(spark, sf_dir):
    archive, incoming = X.archive(spark, sf_dir), X.incoming(spark, sf_dir)
    far = incoming.withColumn("post_id", F.concat(F.lit("far-"), "post_id"))
    parts = []
    for name, batch in (("near", incoming), ("far", far)):
        status, allowed = P.gap_check(batch, archive)
        parts.append(
            status.select(F.lit(name).alias("batch"), "n_posts", "overlap_required", "overlaps", "status")
            .withColumn("n_allowed", allowed.agg(F.count("*").alias("n")).scalar())
        )
    return parts[0].union(parts[1])


@query
def stream_ingest(spark, sf_dir):
    dump, archive, checkpoint = (scratch_path(spark, n) for n in ("dump", "archive", "progress"))
    P.write_posts(X.archive(spark, sf_dir), archive, "v1")
    X.write_dump(X.raw_items(spark, sf_dir), dump)
    P.stream_ingest(spark, dump, archive, checkpoint).awaitTermination()
    return shown(P.read_posts(spark, archive))


@query
def stream_ingest_two_days(spark, sf_dir):
    """Two runs with a checkpoint each; the second finds the files of both days."""
    dump, archive = scratch_path(spark, "dump"), scratch_path(spark, "archive")
    P.write_posts(X.archive(spark, sf_dir), archive, "v1")
    for day, items in (("2025-09-28", X.raw_items(spark, sf_dir)), ("2025-09-29", X.later_items(spark, sf_dir))):
        X.write_dump(items, f"{dump}/{day}")
        P.stream_ingest(spark, f"{dump}/*", archive, scratch_path(spark, "progress")).awaitTermination()
    return shown(P.read_posts(spark, archive))


@query
def daily_update(spark, sf_dir):
    """A day's dump put into an archive by ranges of ids, its stored index and its corpus."""
    dump, archive, index, corpus = (scratch_path(spark, n) for n in ("dump", "archive", "index", "corpus"))
    before = X.archive(spark, sf_dir)
    P.write_posts(before, archive, "v1", clustered=True)
    X.write_dump(X.raw_items(spark, sf_dir), dump)
    P.write_corpus(before, corpus)
    P.write_index(P.build_postings(before, fold=False), before, index, fold=False)
    report = P.daily_update(spark, dump, archive, "v2", index_dir=index, corpus_dir=corpus)
    found, documents = P.read_index(spark, index), P.read_rendered(spark, corpus, F.length("body").alias("n_chars"))
    terms = found.term_stats.agg(F.count("*").alias("n_terms"), F.sum("df").alias("n_postings"))
    bodies = documents.agg(F.count("*").alias("n_documents"), F.sum("n_chars").alias("n_chars"))
    posts = P.read_posts(spark, archive).agg(F.count("*").alias("n_archived"), F.sum("like_count").alias("n_likes"))
    stored = found.totals.join(F.broadcast(terms)).join(F.broadcast(bodies)).join(F.broadcast(posts))
    return report.join(F.broadcast(stored)).select(
        "n_posts", "applied", "n_late", "n_rejected", "overlaps", "db.*", "corpus.*", "archive.total", "archive.original",
        "archive.avg_likes", time_text(F.col("newest")).alias("newest"), time_text(F.col("newest_before")).alias("newest_before"),
        "n_docs", "n_tokens", "n_terms", "n_postings", "n_documents", "n_chars", "n_archived", "n_likes",
    )


@query
def topk_every_hit(spark, sf_dir):
    scored = X.numbered_posts(spark, sf_dir).select(
        F.col("lang").alias("query_id"), "post_id", F.col("like_count").cast("double").alias("score")
    )
    return P.topk(scored, -1).withColumn("n", F.lit("all")).unionByName(
        P.topk(scored, 5_000).withColumn("n", F.lit("5000"))
    )


@query
def archive_check(spark, sf_dir):
    # Rows of two tables under one key, so that every rule has something to find.
    rows = X.posts(spark, sf_dir).unionByName(X.incoming(spark, sf_dir)).withColumns(
        {
            "reply_count": F.col("reply_count") - 1,
            "is_quote": F.when(F.col("like_count") % 50 == 7, 2).otherwise(F.col("is_quote")),
            "reply_to_post_id": F.when(F.col("like_count") % 9 == 0, None).otherwise(F.col("reply_to_post_id")),
            "post_id": F.when(F.col("like_count") % 100 == 3, None).otherwise(F.col("post_id")),
        }
    )
    return P.archive_check(rows)


@query
def sql_posts(spark, sf_dir):
    P.register_views(X.posts(spark, sf_dir))
    return P.run_sql(
        spark,
        "SELECT post_id, like_count, view_count FROM posts WHERE like_count > 500 ORDER BY like_count DESC, post_id",
    )


@query
def sql_index(spark, sf_dir):
    """SQL over posts, postings and term statistics, its rows as JSON."""
    P.register_views(X.posts(spark, sf_dir), X.text_index(spark, sf_dir))
    return P.to_json_rows(P.run_sql(spark, """
        WITH rare AS (SELECT term, df FROM term_stats WHERE df BETWEEN 2 AND 5)
        SELECT p.post_id, p.like_count, count(*) AS n_rare, sum(o.tf) AS n_places, min(r.term) AS first_term
        FROM rare r JOIN postings o ON o.term = r.term JOIN posts p ON p.post_id = o.post_id
        WHERE p.is_repost = 0 GROUP BY p.post_id, p.like_count HAVING count(*) > 1"""))
