"""Fusing keyword and vector rankings by reciprocal rank.

The fused score of a post is the sum of 1 / (k + rank) over the rankings it is in. Ranks
count over whole rankings, but whole rankings are never sorted: a post beyond place k + 2n
in both rankings scores at most 2 / (2k + 2n + 1), and the first n posts of either ranking
score at least 1 / (k + n), which is more. So the best n are among the first k + 2n of each
ranking. Their places in the other ranking are looked up among keyword hits that are shared by
the queries that ask the same words (SharedHits), or found by counting the hits before them: among
keyword hits in their table, among vectors in a second pass that scores them and sends counts
only, so that no pair of a query and a vector leaves a task unless it is a candidate.
"""

from pyspark.sql import Column, DataFrame, functions as F

from postlake.operators.joins import enrich_hits
from postlake.operators.ranking import all_ranks, topk
from postlake.operators.rows import to_json_rows
from postlake.operators.search import SharedHits, search
from postlake.operators.textindex import TextIndex
from postlake.operators.vectors import vector_places, vector_scores, vector_search
from postlake.session import stage

RRF_K = 60

# Labels of the method used.
HYBRID = "hybrid"
KEYWORD = "keyword"


def _place(score: Column, post_id: Column) -> Column:
    """Sorts like a ranking: best score first, ties by post_id."""
    return F.struct((-score).alias("s"), post_id.alias("p"))


def _ranks_of(candidates: DataFrame, hits: DataFrame) -> DataFrame:
    """(query_id, post_id, rank) of those candidates that are in a ranking.

    Hits are counted between the candidates' places, with a partial count per task, so
    the shuffle carries at most one row per query and candidate from each task.
    """
    placed = hits.join(candidates, ["query_id", "post_id"]).withColumn(
        "place", _place(F.col("score"), F.col("post_id"))
    )
    places = stage(
        placed.groupBy("query_id").agg(F.sort_array(F.collect_list("place")).alias("places")), "places"
    )
    slot = F.size(F.filter("places", lambda p: p < _place(F.col("score"), F.col("post_id"))))
    between = (
        hits.join(places, "query_id")
        .groupBy("query_id", slot.alias("slot")).agg(F.count("*").alias("n"))
    )
    slots = between.groupBy("query_id").agg(
        F.map_from_entries(F.collect_list(F.struct("slot", "n"))).alias("counts")
    )
    return (
        places.join(slots, "query_id")
        .select("query_id", "counts", F.posexplode("places").alias("nth", "place"))
        .select(
            "query_id",
            F.col("place.p").alias("post_id"),
            F.aggregate(
                F.sequence(F.lit(0), "nth"),
                F.lit(0).cast("bigint"),
                lambda total, i: total + F.coalesce(F.try_element_at("counts", i), F.lit(0)),
            ).alias("rank"),
        )
    )


def _fused(ranked: list, n: int, k: int) -> DataFrame:
    shares = ranked[0].unionByName(ranked[1]).withColumn("share", 1.0 / (k + F.col("rank")))
    return topk(shares.groupBy("query_id", "post_id").agg(F.round(F.sum("share"), 6).alias("score")), n)


def fuse_rankings(left: DataFrame, right: DataFrame, n: int = 10, k: int = RRF_K) -> DataFrame:
    """Best n posts per query: (query_id, post_id, score, rank), every post for n < 0, of two
    whole rankings (query_id, post_id, score) that are given as tables."""
    lists = [hits.select("query_id", "post_id", "score") for hits in (left, right)]
    if n < 0:
        return _fused([all_ranks(hits).select("query_id", "post_id", "rank") for hits in lists], n, k)
    first = [topk(hits, k + 2 * n).select("query_id", "post_id") for hits in lists]
    candidates = stage(first[0].unionByName(first[1]).distinct(), "candidates")
    return _fused([_ranks_of(candidates, hits) for hits in lists], n, k)


def _first_and_ranks(keyword: DataFrame | SharedHits, n: int):
    """(the first n hits per query, a function from candidates to their ranks) of a keyword ranking."""
    if not isinstance(keyword, SharedHits):
        return topk(keyword, n), lambda candidates: _ranks_of(candidates, keyword)
    first = keyword.asked.join(keyword.hits.where(F.col("rank") <= n), "question")
    return first, lambda candidates: (
        candidates.join(keyword.asked, "query_id").join(keyword.hits, ["question", "post_id"]).select("query_id", "post_id", "rank")
    )


def hybrid_search(
    keyword_hits: DataFrame | SharedHits, query_vectors: DataFrame, vectors: DataFrame, n: int = 10, k: int = RRF_K
) -> DataFrame:
    """Best n posts per query by keyword and vector ranking: (query_id, post_id, score, rank).

    `keyword_hits` is the whole keyword ranking, as search gives it for n = -1, shared or not;
    the vector ranking is made here. For n < 0 every post is ranked, and only then every pair
    is made.
    """
    shared = isinstance(keyword_hits, SharedHits)
    if n < 0:
        keyword = keyword_hits.expanded() if shared else keyword_hits
        return fuse_rankings(stage(keyword.select("query_id", "post_id", "score"), "keyword"), vector_scores(query_vectors, vectors), n, k)
    keyword = keyword_hits if shared else stage(keyword_hits.select("query_id", "post_id", "score"), "keyword")
    by_words, ranks = _first_and_ranks(keyword, k + 2 * n)
    first = by_words, vector_search(query_vectors, vectors, k + 2 * n)
    candidates = stage(first[0].select("query_id", "post_id").unionByName(first[1].select("query_id", "post_id")).distinct(), "candidates")
    return _fused([ranks(candidates), vector_places(candidates, query_vectors, vectors)], n, k)


def search_with_fallback(
    keyword_hits: DataFrame | SharedHits, query_vectors: DataFrame, vectors: DataFrame, n: int = 10, k: int = RRF_K
) -> DataFrame:
    """Hybrid hits for queries that have a vector, keyword hits for the others, labelled.

    A query with a vector and no hits stays without hits; that is a result, no failure.
    """
    with_vector = query_vectors.select(F.col("query_id").cast("string")).distinct()
    if isinstance(keyword_hits, SharedHits):
        own, others = (
            SharedHits(keyword_hits.asked.join(with_vector, "query_id", how), keyword_hits.hits) for how in ("left_semi", "left_anti")
        )
        rows = others.expanded() if n < 0 else others._replace(hits=others.hits.where(F.col("rank") <= n)).expanded()
    else:
        keyword = stage(keyword_hits.select("query_id", "post_id", "score"), "keyword")
        own = keyword.join(with_vector, "query_id", "left_semi")
        rows = topk(keyword.join(with_vector, "query_id", "left_anti"), n)
    fused = hybrid_search(own, query_vectors, vectors, n, k).withColumn("method", F.lit(HYBRID))
    return fused.unionByName(rows.withColumn("method", F.lit(KEYWORD)))


def search_all(
    queries: DataFrame, index: TextIndex, posts: DataFrame, query_vectors: DataFrame, vectors: DataFrame, n: int = 10,
    k: int = RRF_K,
) -> DataFrame:
    """A search from query table to JSON rows (json), one per hit: each query is answered by
    the hybrid ranking if it has a vector and by keywords otherwise, every hit gets its post's
    columns and the label of its method, and posts that are gone keep their hit."""
    hits = search_with_fallback(search(queries, index, -1, shared=True), query_vectors, vectors, n, k)
    rows = stage(hits.withColumn("snippet", F.lit(None).cast("string")), "hits")
    enriched = enrich_hits(rows, posts)
    return to_json_rows(enriched)
