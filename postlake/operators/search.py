"""Keyword search: many queries per job, ranked by BM25, over an index.

Shape of the plan: the table of query words is written first, so its size is known. It meets
the postings on their bucket and term, and as buckets are folders, Spark reads only those in
which a word lies (dynamic partition pruning), for three words or for three thousand. The
matches are shuffled by (query_id, post_id), and units, scores and clauses are worked out
inside those partitions. A word found in a third of all posts gives many small groups, one
per post, so no task gets more than its share.

Prefixes are looked up in the term statistics first and become plain words. Phrases and
proximity groups are found in two steps: posts that hold their two rarest words, without reading
positions; then the positions of all their words in those posts, compared as arrays.

The best n hits for plain words need not read all postings: every zone of the index limits the
score that a post in it can reach. The zone with the highest limit is searched first, and of
the others only those whose limit reaches the n-th score found.
"""

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, functions as F

from postlake.operators.queries import query_units, unit_shapes, unit_words, with_clause_sizes
from postlake.operators.ranking import topk
from postlake.operators.textindex import TextIndex, bucket_of, build_postings, read_index, write_index
from postlake.session import scratch_path, stage
from postlake.sources.segments import only_live

# BM25 constants and the floor of the inverse document frequency.
K1 = 1.2
B = 0.75
IDF_FLOOR = 1e-6

#: Words of a phrase or proximity group that choose the posts in which the others are looked for.
RARE_WORDS = 2
#: Places up to this many are sent to the postings, 8 bytes each.
MAX_BROADCAST_PLACES = 1_000_000

_KEY = ["query_id", "post_id"]


def _asked_terms(units: DataFrame, index: TextIndex, shapes: set) -> DataFrame:
    """One row per term that a unit's word stands for, with the bucket it lies in."""
    words = unit_words(units)
    terms = words.where(~F.col("is_prefix")).withColumn("term", F.col("word"))
    if any(kind == "prefix" for kind, _, _ in shapes):
        prefixes, dictionary = words.where("is_prefix"), index.term_stats.select("term")
        # Equal keys on the first two letters, or one where the prefix has no more.
        for n in {1 if letter else 2 for kind, _, letter in shapes if kind == "prefix"}:
            begins = F.substring("word", 1, n) == F.substring("term", 1, n)
            own = prefixes.where((F.length("word") == 1) if n == 1 else (F.length("word") > 1))
            found = dictionary.join(own, begins).where(F.startswith("term", "word"))
            # A term of several fields is in the statistics once for each.
            terms = terms.unionByName(found.dropDuplicates(["query_id", "unit", "word_no", "term"]).select(terms.columns))
    return stage(terms.drop("word", "is_prefix").withColumn("bucket", bucket_of(F.col("term"), index.buckets)), "terms")


def _matches(index: TextIndex, terms: DataFrame) -> DataFrame:
    """Postings of the terms, in the zones that these may name. The condition on the bucket lets
    Spark see that the terms select."""
    in_field = F.col("only_field").isNull() | (F.col("only_field") == F.col("field"))
    key = [c for c in ("bucket", "zone", "term") if c in terms.columns]
    return index.postings.join(terms.where("bucket >= 0"), key).where(in_field)


def _single_words(matches: DataFrame) -> DataFrame:
    """Units of one word: occurrences per post, over all fields and expanded terms."""
    count = F.when(F.col("kind") == "initial", F.col("opens").cast("int")).otherwise(F.col("tf"))
    return (
        matches.where((F.col("n_words") == 1) & (F.col("kind") != "near"))
        .groupBy(*_KEY, "unit")
        .agg(F.sum(count).alias("tf"), F.max("doc_len").alias("doc_len"))
        .where(F.col("tf") > 0)
        .withColumn("part", F.lit(0))
    )


#: Where the words of a unit meet: a field of a post as one segment has it.
_PLACE = [*_KEY, "unit", "field", "segment"]


def _ordered() -> Column:
    """Whether a unit needs positions."""
    return (F.col("n_words") > 1) | (F.col("kind") == "near")


def _rare_words(terms: DataFrame, index: TextIndex) -> DataFrame:
    """Of the terms of each unit those of its RARE_WORDS words in the fewest posts."""
    in_field = F.col("only_field").isNull() | (F.col("only_field") == F.col("field"))
    word = ["query_id", "unit", "word_no"]
    counted = index.term_stats.join(terms, "term").where(in_field).groupBy(*word).agg(F.sum("df").alias("df"))
    fewest = Window.partitionBy("query_id", "unit").orderBy(F.coalesce("df", F.lit(0)), "word_no")
    words = terms.select(*word).distinct().join(counted, word, "left").withColumn("nth", F.row_number().over(fewest))
    return terms.join(words.where(F.col("nth") <= RARE_WORDS).select(*word), word)


def _candidates(index: TextIndex, terms: DataFrame) -> DataFrame:
    """The fields of posts that hold the rarest words of a unit, as written table."""
    rare = stage(_rare_words(terms, index), "rare")
    held = only_live(_matches(index, rare).select(*_PLACE, "n_words", "word_no"), index.replaced)
    found = held.groupBy(*_PLACE).agg(F.count_distinct("word_no").alias("n"), F.max("n_words").alias("n_words"))
    return stage(found.where(F.col("n") == F.least(F.lit(RARE_WORDS), "n_words")).select(*_PLACE), "candidates", lean=True)


def _places(index: TextIndex, terms: DataFrame) -> DataFrame:
    """Units that need positions, one row per field that holds all their words, with the
    positions of each word (`words`).

    The fields that hold the rarest words are found first, from postings without positions, and
    written. Unless they are very many they are sent to the postings as numbers, so that no other
    post's are shuffled, however common a unit's other words are.
    """
    own = terms.where(_ordered())
    candidates = _candidates(index, own)
    found = _matches(index, own).select(*_PLACE, "kind", "n_words", "near_k", "doc_len", "tf", "word_no", "positions")
    if candidates.count() <= MAX_BROADCAST_PLACES:
        # Other places of the same numbers go at the end.
        place = F.xxhash64(*_PLACE)
        numbers = candidates.select(place.alias("place")).distinct()
        found = found.withColumn("place", place).join(F.broadcast(numbers), "place", "left_semi").drop("place")
    else:
        found = found.join(candidates, _PLACE, "left_semi")
    return (
        found.groupBy(*_PLACE)
        .agg(
            F.first("kind").alias("kind"), F.max("n_words").alias("n_words"), F.max("near_k").alias("near_k"),
            F.max("doc_len").alias("doc_len"), F.collect_list(F.struct("word_no", "tf", "positions")).alias("words"),
        )
        .where(F.size(F.array_distinct(F.transform("words", lambda w: w["word_no"]))) == F.col("n_words"))
        .join(candidates, _PLACE, "left_semi")
    )


def _phrases(places: DataFrame) -> DataFrame:
    """Units of several words in order: an occurrence is a start at which all words fit."""

    def starts(word_no: Column) -> Column:
        own = F.filter("words", lambda w: w["word_no"] == word_no)
        return F.transform(F.flatten(F.transform(own, lambda w: w["positions"])), lambda p: p - word_no)

    fit = F.reduce(
        F.sequence(F.lit(1), F.col("n_words") - 1), starts(F.lit(0)), lambda left, i: F.array_intersect(left, starts(i))
    )
    opening = F.when(F.col("kind") == "initial", F.filter("fit", lambda start: start == 0)).otherwise(F.col("fit"))
    return (
        places.where(F.col("kind") != "near").select(*_KEY, "unit", "doc_len", "kind", fit.alias("fit"))
        .select(*_KEY, "unit", "doc_len", F.size(opening).alias("n"))
        .groupBy(*_KEY, "unit")
        .agg(F.sum("n").alias("tf"), F.max("doc_len").alias("doc_len"))
        .where(F.col("tf") > 0)
        .withColumn("part", F.lit(0))
    )


def _is_near(places: Column, n_words: Column, near_k: Column) -> Column:
    """Whether some stretch of a field holds every word with at most near_k others between.

    One pass over the places in order, keeping the last place of each word.
    """
    unseen = F.lit(None).cast("int")
    start = F.struct(
        F.array_repeat(unseen, n_words).alias("last"), F.lit(False).alias("found")
    )

    def step(state, place):
        last = F.transform(
            state["last"], lambda seen, i: F.when(i == place["word_no"], place["pos"]).otherwise(seen)
        )
        all_seen = F.forall(last, lambda seen: seen.isNotNull())
        close = all_seen & (place["pos"] - F.array_min(last) - 1 <= near_k)
        return F.struct(last.alias("last"), (state["found"] | close).alias("found"))

    return F.aggregate(places, start, step, lambda state: state["found"])


def _near_groups(places: DataFrame) -> DataFrame:
    """Proximity groups. Each word of a matching group is ranked as a plain word (`part`)."""
    in_order = F.sort_array(F.flatten(F.transform(
        "words", lambda w: F.transform(w["positions"], lambda p: F.struct(p.alias("pos"), w["word_no"].alias("word_no")))
    )))
    close = places.where(F.col("kind") == "near").where(_is_near(in_order, F.col("n_words"), F.col("near_k")))
    return (
        close.select(*_KEY, "unit", "doc_len", F.explode(F.transform("words", lambda w: F.struct(w["word_no"], w["tf"]))).alias("w"))
        .select(*_KEY, "unit", "doc_len", F.col("w.word_no").alias("part"), "w.tf")
        .groupBy(*_KEY, "unit", "part")
        .agg(F.sum("tf").alias("tf"), F.max("doc_len").alias("doc_len"))
    )


def _plain_frequencies(terms: DataFrame, stats: DataFrame) -> DataFrame:
    """Posts per single word, from the term statistics: (query_id, unit, part, df)."""
    plain = terms.where(
        (F.col("kind") == "near") | ((F.col("kind") == "phrase") & (F.col("n_words") == 1))
    )
    matched = stats.join(plain, "term")
    in_field = F.col("only_field").isNull() | (F.col("only_field") == F.col("field"))
    part = F.when(F.col("kind") == "near", F.col("word_no")).otherwise(0)
    return (
        matched.where(in_field)
        .groupBy("query_id", "unit", part.alias("part"))
        .agg(F.sum(F.when(F.col("only_field").isNull(), F.col("lead_df")).otherwise(F.col("df"))).alias("df"))
    )


def _bm25(tf: Column, df: Column, doc_len: Column, n_docs: Column, n_tokens: Column) -> Column:
    raw = F.log((n_docs - df + 0.5) / (df + 0.5))
    idf = F.when(raw <= 0, F.lit(IDF_FLOOR)).otherwise(raw)
    relative = doc_len * n_docs / n_tokens
    return idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * relative))


class _Asked:
    """A unit table made ready: written, since tables of a known size are joined by Spark as it
    suits them, with the kinds of its units and the terms of the index they ask for."""

    def __init__(self, units: DataFrame, index: TextIndex):
        self.index = index
        self.units = stage(with_clause_sizes(units), "units")
        self.shapes = unit_shapes(self.units)
        self.terms = _asked_terms(self.units, index, self.shapes)
        self.only_words = all(kind == "phrase" and not several for kind, several, _ in self.shapes)


def score_units(units: DataFrame, index: TextIndex) -> DataFrame:
    """(query_id, post_id, score) for every post that matches, unranked. `units` has the schema
    UNITS."""
    asked = _Asked(units, index)
    return _score(asked, asked.terms)


def _score(asked: _Asked, terms: DataFrame, frequencies: DataFrame | None = None) -> DataFrame:
    """The scores by the postings of the terms; frequencies are counted unless they are given."""
    units, index, shapes = asked.units, asked.index, asked.shapes
    kinds = {kind for kind, _, _ in shapes}
    ordered_words = any(several and kind != "near" for kind, several, _ in shapes)
    one_word = any(not several and kind != "near" for kind, several, _ in shapes)

    # Positions are read here only to see whether a word opens a field.
    opens = F.array_contains("positions", 0) if ("initial", False, False) in shapes else F.lit(None).cast("boolean")
    parts = []
    if one_word:
        matches = only_live(
            _matches(index, terms.where(~_ordered())).select(
                *_PLACE, "kind", "n_words", "near_k", "word_no", "tf", "doc_len", opens.alias("opens")
            ), index.replaced,
        ).repartition(*_KEY)
        parts.append(_single_words(matches))
    if ordered_words or "near" in kinds:
        places = _places(index, terms)
        if ordered_words and "near" in kinds:
            places = stage(places, "places")
        parts += [_phrases(places)] if ordered_words else []
        parts += [_near_groups(places)] if "near" in kinds else []
    if not parts:
        return units.sparkSession.createDataFrame([], "query_id string, post_id string, score double")
    found = reduce(DataFrame.unionByName, parts)

    # Plain words have their frequency in the term statistics; other units are counted.
    given = frequencies is not None
    frequencies = frequencies if given else _plain_frequencies(terms, index.term_stats)
    if ordered_words or kinds & {"prefix", "initial"}:
        found = stage(found, "found", lean=True)
        counted = units.where(
            F.col("kind").isin("prefix", "initial")
            | ((F.col("kind") == "phrase") & (F.size("words") > 1))
        )
        frequencies = frequencies.unionByName(
            found.join(counted, ["query_id", "unit"], "left_semi")
            .groupBy("query_id", "unit", "part").agg(F.count("doc_len").alias("df"))
        )
    return _apply_clauses(_ranked(asked, found, frequencies if given else stage(frequencies, "frequencies")))


def _ranked(asked: _Asked, found: DataFrame, frequencies: DataFrame) -> DataFrame:
    """Found units (query_id, unit, part, tf, doc_len) with their roles and scores."""
    totals = asked.index.totals.select(F.struct("n_docs", "n_tokens").alias("t")).scalar()
    roles = asked.units.select("query_id", "unit", "clause", "negated", "n_negated", "n_clauses", "n_preset")
    return (
        found.join(frequencies, ["query_id", "unit", "part"])
        .join(roles, ["query_id", "unit"])
        .withColumn(
            "score",
            _bm25(F.col("tf"), F.col("df"), F.col("doc_len"), totals["n_docs"], totals["n_tokens"]),
        )
    )


def _zone_limits(asked: _Asked, frequencies: DataFrame) -> DataFrame:
    """(query_id, zone, most): no post of the zone scores more for the query. Zones in which a
    query cannot match are left out. A row per query and zone."""
    in_field = F.col("only_field").isNull() | (F.col("only_field") == F.col("field"))
    # A post has no more occurrences than the most of each field together.
    limits = asked.index.bounds.join(asked.terms, "term").where(in_field).groupBy("query_id", "unit", "zone", "field").agg(
        F.max("max_tf").alias("tf"), F.min("min_len").alias("doc_len")
    ).groupBy("query_id", "unit", "zone").agg(F.sum("tf").alias("tf"), F.min("doc_len").alias("doc_len")).withColumn("part", F.lit(0))
    wanted = ~F.col("negated")
    return (
        _ranked(asked, limits, frequencies).groupBy("query_id", "zone").agg(
            F.coalesce(F.sum(F.when(wanted, F.col("score"))), F.lit(0.0)).alias("most"),
            F.count_distinct(F.when(wanted & (F.col("n_negated") == 0), F.col("clause"))).alias("n_met"),
            F.max(F.col("n_clauses") - F.col("n_preset")).alias("n_needed"),
        )
        .where("n_met = n_needed").select("query_id", "zone", "most")
    )


def _first_and_rest(asked: _Asked, n: int):
    """(the best n hits of each query's most promising zone, the zones that may hold better ones,
    frequencies)."""
    frequencies = stage(_plain_frequencies(asked.terms, asked.index.term_stats), "frequencies")
    order = Window.partitionBy("query_id").orderBy(F.desc("most"), "zone")
    zones = stage(_zone_limits(asked, frequencies).withColumn("nth", F.row_number().over(order)), "zones")
    terms = asked.terms.join(zones.where("nth = 1").select("query_id", "zone"), "query_id")
    first = stage(topk(_score(asked, terms, frequencies), n).drop("rank"), "first")
    reached = first.groupBy("query_id").agg(F.when(F.count("*") >= n, F.min("score")).alias("reached"))
    # Scores are rounded to six places.
    rest = zones.where("nth > 1").join(reached, "query_id", "left").where(
        F.col("reached").isNull() | (F.col("most") >= F.col("reached") - 1e-6)
    )
    return first, stage(rest.select("query_id", "zone"), "zones"), frequencies


def _best(asked: _Asked, n: int) -> DataFrame:
    first, rest, frequencies = _first_and_rest(asked, n)
    if rest.isEmpty():
        return topk(first, n)
    return topk(first.unionByName(_score(asked, asked.terms.join(rest, "query_id"), frequencies)), n)


def _apply_clauses(scored: DataFrame) -> DataFrame:
    """Keep the posts for which every clause of the query holds.

    A clause with a negated unit holds unless something speaks against it, so it counts as
    held from the start and a post's rows only correct that.
    """
    query_figures = [F.max(c).alias(c) for c in ("n_clauses", "n_preset")]
    # The unit is what matches: words of one proximity group count once.
    per_unit = scored.groupBy(*_KEY, "clause", "unit", "negated").agg(
        F.sum("score").alias("score"), F.max("n_negated").alias("n_negated"), *query_figures
    )
    per_clause = per_unit.groupBy(*_KEY, "clause").agg(
        F.sum(F.when(F.col("negated"), 0.0).otherwise(F.col("score"))).alias("score"),
        F.count_if(~F.col("negated")).alias("n_for"),
        F.count_if("negated").alias("n_against"),
        F.max("n_negated").alias("n_negated"),
        *query_figures,
    )
    holds = (F.col("n_for") > 0) | (F.col("n_against") < F.col("n_negated"))
    gain = holds.cast("int") - (F.col("n_negated") > 0).cast("int")
    return (
        per_clause.groupBy(*_KEY)
        .agg(F.sum("score").alias("score"), F.sum(gain).alias("gain"), *query_figures)
        .where(F.col("gain") == F.col("n_clauses") - F.col("n_preset"))
        .select(*_KEY, F.round("score", 6).alias("score"))
    )


class SharedHits(NamedTuple):
    """Whole rankings, made once for all queries that ask the same: `asked` (query_id, question)
    says which ranking is a query's, `hits` (question, post_id, score, rank) holds them. One-word
    questions have no more hits in all than the index has postings, however many queries ask."""

    asked: DataFrame
    hits: DataFrame

    def expanded(self) -> DataFrame:
        """A row per query and hit."""
        return self.asked.join(self.hits, "question").select("query_id", "post_id", "score", "rank")


def _shared_rankings(units: DataFrame, index: TextIndex) -> SharedHits:
    """Whole rankings of a unit table. Queries ask the same if their units are equal; the least
    id of them names the question."""
    asks = F.to_json(F.sort_array(F.collect_list(F.struct("unit", "clause", "negated", "kind", "words", "near_k", "field"))))
    asking = stage(units.groupBy("query_id").agg(asks.alias("asks")), "asking")
    questions = asking.groupBy("asks").agg(F.min("query_id").alias("question"))
    asked = stage(asking.join(questions, "asks").select("query_id", "question"), "asked")
    own = units.join(asked.where("query_id = question").select("query_id"), "query_id", "left_semi")
    found = _Asked(own, index)
    return SharedHits(asked, stage(topk(_score(found, found.terms), -1).withColumnRenamed("query_id", "question"), "ranked"))


def search_units(units: DataFrame, index: TextIndex, n: int = 10, shared: bool = False) -> DataFrame | SharedHits:
    """Best n hits per query for a unit table (schema UNITS), which allows nested logic; for
    n < 0 whole rankings, as SharedHits if `shared`."""
    if n < 0:
        rankings = _shared_rankings(units, index)
        return rankings if shared else rankings.expanded()
    asked = _Asked(units, index)
    if asked.only_words and n > 0 and index.bounds is not None:
        return _best(asked, n)
    return topk(_score(asked, asked.terms), n)


def search(queries: DataFrame, index: TextIndex, n: int = 10, shared: bool = False) -> DataFrame | SharedHits:
    """Best n hits per query over an index: (query_id, post_id, score, rank). For n < 0 whole
    rankings; `shared` gives them without a row per query and hit (see SharedHits)."""
    return search_units(query_units(queries, index.fold), index, n, shared)


def search_posts(
    queries: DataFrame, posts: DataFrame, n: int = 10, fields=("content",), fold: bool = True
) -> DataFrame:
    """Like search, over posts that have no index yet: one is stored in the shared folder for
    this call. Whoever searches twice stores it with write_index."""
    spark = posts.sparkSession
    path = scratch_path(spark, "index")
    write_index(build_postings(posts, fields, fold), posts, path, fields=fields, fold=fold)
    return search(queries, read_index(spark, path), n)
