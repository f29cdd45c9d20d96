"""Search against SQLite FTS5 and brute force, and the paths for large query tables."""

import math
import random
import sqlite3

import numpy as np
import pyarrow as pa
import pytest

import postlake as P
from postlake.operators import ranking, search as S, textindex as T, vectors as V
from postlake.plans.registry import search_table
from postlake.schemas import UNITS
from pyspark.sql import functions as F

WORDS = ["alpha", "beta", "gamma", "delta", "epsilon", "zeta", "eta", "theta", "iota", "kappa", "Café", "naïve", "übergang"]


def documents():
    rng = random.Random(7)
    rows = []
    for i in range(60):
        text = " ".join(rng.choices(WORDS, k=rng.randint(1, 25)))
        title = " ".join(rng.choices(WORDS, k=rng.randint(0, 3)))
        rows.append((f"{i:03d}", text.replace(" ", ", ", 1), title))
    return rows + [("900", None, None), ("901", "", "")]


@pytest.fixture(scope="module")
def posts(spark):
    return spark.createDataFrame(documents(), "post_id string, content string, title string").repartition(3)


@pytest.fixture(scope="module")
def fts():
    con = sqlite3.connect(":memory:")
    try:
        con.execute("CREATE VIRTUAL TABLE t USING fts5(content, title)")
    except sqlite3.OperationalError:
        pytest.skip("FTS5 is not compiled in")
    con.executemany("INSERT INTO t(rowid, content, title) VALUES (?, ?, ?)", [(int(i), c, t) for i, c, t in documents()])
    return con


CASES = {
    "and": ({"must": ["epsilon", "zeta"]}, "epsilon AND zeta"),
    "or": ({"should": ["epsilon", "zeta"]}, "epsilon OR zeta"),
    "and or not": ({"must": ["alpha"], "should": ["beta", "gamma"], "must_not": ["eta"]}, "(alpha AND (beta OR gamma)) NOT eta"),
    "phrase": ({"phrase": ["beta", "gamma"]}, '"beta gamma"'),
    "phrase over a comma": ({"must": ["alpha beta"]}, '"alpha beta"'),
    "not a phrase": ({"must": ["beta"], "must_not": ["beta gamma"]}, 'beta NOT "beta gamma"'),
    "prefix": ({"prefix": ["ep"]}, "ep*"),
    "long prefix": ({"prefix": ["theta e"]}, '"theta e" *'),
    "initial": ({"initial": ["kappa"]}, "^kappa"),
    "initial phrase": ({"initial": ["alpha beta"]}, "^ alpha + beta"),
    "field": ({"must": ["iota"], "field": "title"}, "title : iota"),
    "folded": ({"must": ["cafe", "UBERGANG"]}, "cafe AND ubergang"),
    "missing": ({"must": ["alpha", "nothing"]}, "alpha AND nothing"),
    "near anywhere": ({"near": ["beta", "gamma"], "near_k": 2_000_000_000}, "NEAR(beta gamma, 2000000000)"),
    "no words beside": ({"should": ["beta", "!!!"]}, "beta"),
    "no words forbidden": ({"must": ["beta"], "must_not": ["!!!"]}, "beta"),
}
#: FTS5 takes a text without words out of an expression of its own; all of `must` is required.
WORDLESS = {"required": {"must": ["beta", "!!!"]}, "alone": {"must": ["..."]}, "phrase": {"phrase": ["--"]}, "near": {"near": ["?"]}}
FIELDS = ("content", "title")
RANKED = [name for name in CASES if not name.startswith("near")]


@pytest.fixture(scope="module")
def stored(spark, posts, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("search") / "index")
    P.write_index(P.build_postings(posts, FIELDS), posts, path, buckets=7, fields=FIELDS)
    return path


@pytest.fixture(scope="module")
def updated(spark, posts, tmp_path_factory):
    """An index of other posts, brought to the same posts by two updates."""
    path = str(tmp_path_factory.mktemp("search") / "updated")
    first = posts.where("post_id <> '005' AND post_id < '055'").withColumn(
        "content", F.when(F.col("post_id") < "020", F.concat("content", F.lit(" beta gamma"))).otherwise(F.col("content"))
    ).unionByName(spark.createDataFrame([("extra", "alpha beta", "zeta")], "post_id string, content string, title string"))
    P.write_index(P.build_postings(first, FIELDS), first, path, buckets=5, fields=FIELDS)
    middle = posts.where("post_id < '030' OR post_id >= '900'")
    for batch, gone in ((middle, None), (posts, "extra")):
        ids = spark.createDataFrame([(gone,)], "post_id string")
        P.write_segment(spark, path, *P.index_changes(batch, first, ids, FIELDS))
        first = batch.unionByName(first.join(batch.select("post_id").union(ids), "post_id", "left_anti"))
    return path


def test_search_equals_fts5(spark, posts, fts):
    queries = search_table(spark, *[{"query_id": k, **q} for k, (q, _) in CASES.items()])
    got = {}
    for row in P.search_posts(queries, posts, -1, fields=FIELDS).collect():
        got.setdefault(row.query_id, {})[row.post_id] = row.score
    for name, (_, text) in CASES.items():
        want = {f"{i:03d}": -s for i, s in fts.execute("SELECT rowid, rank FROM t WHERE t MATCH ?", (text,))}
        assert got.get(name, {}).keys() == want.keys(), name
        for post_id, score in want.items() if name in RANKED else ():
            assert got[name][post_id] == pytest.approx(score, abs=1e-6), (name, post_id)


def test_texts_without_words_match_nothing(spark, stored):
    queries = search_table(spark, *[{"query_id": k, **q} for k, q in WORDLESS.items()])
    assert P.search(queries, P.read_index(spark, stored), -1).count() == 0


@pytest.mark.parametrize("k", [0, 1, 2, 5, 10])
def test_near_matches_fts5(spark, stored, fts, k):
    # Which posts match is compared; the ranking inside proximity groups is our own choice.
    queries = search_table(spark, {"query_id": "2", "near": ["beta", "gamma"], "near_k": k},
                           {"query_id": "3", "near": ["beta", "gamma", "eta"], "near_k": k})
    rows = P.search(queries, P.read_index(spark, stored), -1).collect()
    for name, words in (("2", "beta gamma"), ("3", "beta gamma eta")):
        want = {f"{i:03d}" for (i,) in fts.execute("SELECT rowid FROM t WHERE t MATCH ?", (f"NEAR({words}, {k})",))}
        assert {r.post_id for r in rows if r.query_id == name} == want


def test_nested_logic(spark, posts, fts):
    # alpha OR (beta NOT gamma) = (alpha OR beta) AND (alpha OR NOT gamma)
    def unit(number, clause, word, negated=False):
        return ("q", number, clause, negated, "phrase", [word], 10, "content")

    units = spark.createDataFrame(
        [unit(0, 0, "alpha"), unit(1, 0, "beta"), unit(2, 1, "alpha"), unit(3, 1, "gamma", True)], UNITS)
    got = {r.post_id for r in P.search_units(units, P.build_index(posts), -1).collect()}
    want = {f"{i:03d}" for (i,) in fts.execute("SELECT rowid FROM t WHERE t MATCH 'content : (alpha OR (beta NOT gamma))'")}
    assert got == want


def every_case(spark):
    return search_table(spark, *[{"query_id": k, **q} for k, (q, _) in CASES.items()])


def test_stored_updated_and_merged_index_give_the_same_hits(spark, posts, stored, updated):
    index = P.build_index(posts, FIELDS)
    want = sorted(P.search(every_case(spark), index, 5).collect())
    assert sorted(P.search(every_case(spark), P.read_index(spark, stored), 5).collect()) == want
    assert len(P.published_segments(spark, updated)) == 3
    for segments in (3, 1):
        read = P.read_index(spark, updated)
        assert len(P.published_segments(spark, updated)) == segments
        assert read.totals.head() == index.totals.head()
        assert sorted(P.live_postings(read).collect()) == sorted(P.build_postings(posts, FIELDS).collect())
        assert sorted(read.term_stats.collect()) == sorted(index.term_stats.select("term", "field", "df", "lead_df").collect())
        assert sorted(P.search(every_case(spark), read, 5).collect()) == want
        if segments == 3:
            P.merge_segments(spark, updated)


def test_an_update_writes_only_its_batch(spark, posts, tmp_path):
    path = str(tmp_path / "index")
    P.write_index(P.build_postings(posts, FIELDS), posts, path, fields=FIELDS)
    before = {f: f.stat().st_mtime_ns for f in (tmp_path / "index").rglob("*.parquet")}
    batch = posts.where("post_id IN ('003', '004')").withColumn(
        "content", F.when(F.col("post_id") == "003", F.lit("omega psi")).otherwise(F.col("content")))
    changed, outdated = P.index_changes(batch, posts, None, FIELDS)
    P.write_segment(spark, path, changed, outdated)
    assert all(f.stat().st_mtime_ns == t for f, t in before.items())
    new = spark.read.parquet(f"{path}/postings/segment=2")
    assert {r.post_id for r in new.select("post_id").distinct().collect()} == {"003"}
    hits = P.search(search_table(spark, {"query_id": "q", "must": ["omega"]}), P.read_index(spark, path), 5)
    assert [r.post_id for r in hits.collect()] == ["003"]
    # A batch that changes no text adds an empty segment and changes no hit.
    P.write_segment(spark, path, *P.index_changes(batch, batch, None, FIELDS))
    assert [r.post_id for r in P.search(search_table(spark, {"query_id": "q", "must": ["omega"]}), P.read_index(spark, path), 5).collect()] == ["003"]


def test_unpublished_segments_do_not_count(spark, posts, tmp_path):
    path = str(tmp_path / "index")
    P.write_index(P.build_postings(posts), posts, path)
    (tmp_path / "index" / "postings" / "segment=2").mkdir()
    (tmp_path / "index" / "published" / "segment=2").mkdir()
    assert [s.segment for s in P.published_segments(spark, path)] == [1]
    # The first segment of a stored index is written once.
    with pytest.raises(Exception, match="already exists"):
        P.write_index(P.build_postings(posts), posts, path)


@pytest.mark.parametrize("n_words", [3, 3_000])
def test_buckets_are_pruned_by_the_words(spark, posts, stored, n_words):
    """One plan for few words and for many: the folders to read follow from the words."""
    words = ["alpha", "beta", "nothing"] + [f"missing{i}" for i in range(n_words - 3)]
    queries = spark.createDataFrame([(w, [w]) for w in words], "query_id string, must array<string>")
    index = P.read_index(spark, stored)
    terms = S._asked_terms(S.with_clause_sizes(P.query_units(queries)), index, {("phrase", False, False)})
    matches = S._matches(index, terms)
    text = matches._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in text and "BroadcastNestedLoop" not in text and "Cartesian" not in text
    assert {r.term for r in matches.select("term").distinct().collect()} == {"alpha", "beta"}
    assert {r.query_id for r in P.search(queries, index, 3).collect()} == {"alpha", "beta"}


def lengths(rng):
    """Posts of very different length; the words asked for are denser in some."""
    rows = []
    for i in range(600):
        n = rng.choice([3, 6, 20, 60, 200, 700])
        words = rng.choices(["mill", "river", "stone"], k=rng.choice([1, 1, 2, 4])) + rng.choices("abcdefgh", k=n)
        rng.shuffle(words)
        rows.append((f"{i:03d}", " ".join(words)))
    return rows


def test_zones_that_cannot_reach_the_best_are_not_read(spark, tmp_path):
    posts = spark.createDataFrame(lengths(random.Random(2)), "post_id string, content string")
    path = str(tmp_path / "index")
    P.write_index(P.build_postings(posts), posts, path, buckets=3)
    P.write_segment(spark, path, *P.index_changes(
        spark.createDataFrame([("new", "mill mill stone"), ("001", "river")], "post_id string, content string"), posts, posts.where("post_id = '005'")))
    index = P.read_index(spark, path)
    queries = search_table(
        spark, {"query_id": "one", "must": ["mill"]}, {"query_id": "both", "must": ["mill", "river"]},
        {"query_id": "any", "should": ["stone", "river", "none"]}, {"query_id": "not", "must": ["stone"], "must_not": ["mill", "a"]},
        {"query_id": "none", "must": ["mill", "none"]}, {"query_id": "field", "must": ["river"], "field": "content"},
    )
    for n in (1, 3, 10, 700):
        whole = P.topk(S.score_units(P.query_units(queries), index), n)
        assert sorted(P.search(queries, index, n).collect()) == sorted(whole.collect())
    asked = S._Asked(P.query_units(queries.where("query_id = 'one'")), index)
    first, rest, _ = S._first_and_rest(asked, 3)
    there = index.postings.where("term = 'mill'")
    zones = [r.zone for r in there.select("zone").distinct().collect()]
    read = {r.zone for r in rest.collect()} | {r.zone for r in first.join(there, "post_id").select("zone").distinct().collect()}
    assert first.count() == 3 and len(read) < len(zones)
    assert there.where(F.col("zone").isin(*read)).count() < there.count()
    text = S._matches(index, asked.terms.join(rest, "query_id"))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in text and text.count("dynamicpruning") >= 2


def test_positions_are_not_exploded(spark, stored):
    queries = search_table(spark, {"query_id": "p", "phrase": ["beta", "gamma"]}, {"query_id": "x", "prefix": ["theta e"]})
    plan = P.search(queries, P.read_index(spark, stored), 3)._jdf.queryExecution().analyzed().toString()
    assert "explode(positions" not in plan and "substring(term, 1, 5)" not in plan


def test_topk_is_the_head_of_the_full_ranking(spark, posts):
    queries = search_table(spark, {"query_id": "q", "should": ["alpha", "beta"]})
    full = sorted(P.search_posts(queries, posts, -1).collect(), key=lambda r: (-r.score, r.post_id))
    best = sorted(P.search_posts(queries, posts, 7).collect(), key=lambda r: r["rank"])
    assert [(r.post_id, r.score) for r in best] == [(r.post_id, r.score) for r in full[:7]]


def test_topk_beyond_the_group_limit(spark):
    hits = spark.range(5000).select(
        (F.col("id") % 2).cast("string").alias("query_id"), F.col("id").cast("string").alias("post_id"),
        (F.col("id") % 97).cast("double").alias("score"))
    rows = P.topk(hits, 1500).collect()
    for query_id in "01":
        want = sorted(((-float(i % 97), str(i)) for i in range(int(query_id), 5000, 2)))[:1500]
        got = sorted((r["rank"], -r.score, r.post_id) for r in rows if r.query_id == query_id)
        assert [g[1:] for g in got] == want
    every = P.topk(hits, -1).collect()
    assert len(every) == 5000
    assert sorted((r["rank"], -r.score, r.post_id) for r in every if r.query_id == "1") == [
        (n + 1, *w) for n, w in enumerate(sorted((-float(i % 97), str(i)) for i in range(1, 5000, 2)))]


def test_refresh_equals_rebuild(spark, posts):
    after = posts.where("post_id <> '003'").withColumn(
        "content", F.when(F.col("post_id") < "010", F.concat("content", F.lit(" omega"))).otherwise(F.col("content")))
    changed, removed = P.changed_posts(posts, after, ("content", "title"))
    assert changed.count() == 9 and removed.count() == 1
    fields = ("content", "title")
    refreshed = P.refresh_postings(P.build_postings(posts, fields), changed, removed, fields)
    assert sorted(refreshed.collect()) == sorted(P.build_postings(after, fields).collect())
    assert sorted(P.term_stats(refreshed).collect()) == sorted(P.term_stats(P.build_postings(after, fields)).collect())


def test_postings_are_built_without_a_shuffle(spark, posts):
    frame = P.build_postings(spark.createDataFrame([("1", "a b a")], "post_id string, content string"))
    assert "Exchange" not in frame._jdf.queryExecution().executedPlan().toString()
    assert [(r.term, r.tf, r.positions) for r in frame.collect()] == [("a", 2, [0, 2]), ("b", 1, [1])]


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(3)
    rows = [(f"{i:03d}", rng.normal(size=8).round(1).tolist()) for i in range(80)]
    rows += [(f"copy{i}", rows[0][1]) for i in range(40)] + [("zero", [0.0] * 8), ("none", None)]
    return rows, spark.createDataFrame(rows, "post_id string, embedding array<float>").repartition(4)


def brute(rows, asked):
    out = {}
    for query_id, q in asked:
        q = np.array(q, dtype=np.float32).astype(float)
        ranked = []
        for post_id, v in rows:
            if v is None or not any(v):
                continue
            v = np.array(v, dtype=np.float32).astype(float)
            ranked.append((-round(float(q @ v / np.linalg.norm(q) / np.linalg.norm(v)), 6), post_id))
        out[query_id] = sorted(ranked)
    return out


def on_grid(monkeypatch):
    """Few queries and vectors at a time, so that the grid of both has several cells."""
    whole = V._on_vectors
    monkeypatch.setattr(V, "_on_vectors", lambda q, p, work, schema, _: whole(q, p, work, schema, block=2, shard=30))
    monkeypatch.setattr(V, "SCORES_AT_A_TIME", 16)


@pytest.mark.parametrize("limit", [4_096, 0], ids=["carried", "joined"])
def test_vector_search_equals_brute_force(spark, vectors, monkeypatch, limit):
    rows, frame = vectors
    monkeypatch.setattr(V, "MAX_CARRIED_QUERIES", limit)
    if limit == 0:
        on_grid(monkeypatch)
    asked = [(f"q{i}", rows[i][1]) for i in range(5)]
    got = P.vector_search(spark.createDataFrame(asked, "query_id string, embedding array<float>"), frame, 6).collect()
    for query_id, ranked in brute(rows, asked).items():
        mine = sorted((r["rank"], r.post_id, r.score) for r in got if r.query_id == query_id)
        assert [m[1] for m in mine] == [p for _, p in ranked[:6]]
        assert [m[2] for m in mine] == pytest.approx([-s for s, _ in ranked[:6]], abs=2e-6)


def fuse(left, right, n, k):
    total = {}
    for ranking_ in (left, right):
        for place, (_, post_id) in enumerate(sorted((-s, p) for p, s in ranking_), 1):
            total[post_id] = total.get(post_id, 0) + 1 / (k + place)
    best = sorted((-math.floor(s * 1e6 + 0.5) / 1e6, p) for p, s in total.items())
    return [(p, pytest.approx(-s, abs=1e-6)) for s, p in (best if n < 0 else best[:n])]


@pytest.mark.parametrize("n, k", [(3, 2), (1, 0), (5, 60), (-1, 5)])
def test_fusion_of_given_rankings(spark, n, k):
    rng = random.Random(n * 100 + k)
    lists = {}
    for query_id in ("a", "b", "c"):
        ids = [f"p{i}" for i in range(300)]
        lists[query_id] = [
            [(p, round(rng.choice([rng.random(), 0.5]), 6)) for p in rng.sample(ids, size)]
            for size in ((200, 250) if query_id == "a" else (2, 250) if query_id == "b" else (0, 4))
        ]
    frames = [
        spark.createDataFrame(
            [(q, p, s) for q, both in lists.items() for p, s in both[side]], "query_id string, post_id string, score double")
        for side in (0, 1)
    ]
    rows = P.fuse_rankings(*frames, n, k).collect()
    for query_id, (left, right) in lists.items():
        mine = sorted(((-r.score, r.post_id) for r in rows if r.query_id == query_id))
        assert [(p, -s) for s, p in mine] == fuse(left, right, n, k)


@pytest.mark.parametrize("n, k, grid", [(3, 2, False), (1, 0, True), (5, 60, True), (-1, 5, False)])
def test_hybrid_equals_whole_fusion(spark, vectors, monkeypatch, n, k, grid):
    """Vectors with many ties and copies, with and without a keyword ranking."""
    if grid:
        on_grid(monkeypatch)
    rows, frame = vectors
    rng = random.Random(n * 100 + k)
    asked = [(f"q{i}", rows[i][1]) for i in range(5)] + [("zero", [0.0] * 8)]
    ids = [p for p, _ in rows]
    words = {q: [(p, rng.choice([0.5, rng.random()])) for p in rng.sample(ids, size)] for (q, _), size in zip(asked, (80, 3, 0, 100, 40, 5))}
    keyword = spark.createDataFrame([(q, p, s) for q, hits in words.items() for p, s in hits], "query_id string, post_id string, score double")
    got = P.hybrid_search(keyword, spark.createDataFrame(asked, "query_id string, embedding array<float>"), frame, n, k).collect()
    near = brute(rows, asked[:-1]) | {"zero": []}
    for query_id, hits in words.items():
        mine = sorted((-r.score, r.post_id) for r in got if r.query_id == query_id)
        assert [(p, -s) for s, p in mine] == fuse([(p, -s) for s, p in near[query_id]], hits, n, k)


def test_hybrid_makes_no_pairs(spark, vectors):
    rows, frame = vectors
    asked = spark.createDataFrame([(f"q{i}", rows[i][1]) for i in range(5)], "query_id string, embedding array<float>")
    candidates = spark.createDataFrame([("q0", "copy3"), ("q0", "007"), ("q1", "020")], "query_id string, post_id string")
    got = {(r.query_id, r.post_id): r["rank"] for r in V.vector_places(candidates, asked, frame).collect()}
    near = brute(rows, [(f"q{i}", rows[i][1]) for i in range(2)])
    assert got == {(q, p): 1 + [x for _, x in near[q]].index(p) for q, p in (("q0", "copy3"), ("q0", "007"), ("q1", "020"))}
    query = pa.table({"query_id": ["q"], "embedding": [rows[0][1]], "place_scores": [[1.0, 0.5]], "place_ids": [["000", "x"]]})
    tables = (pa.table({"post_id": [p for p, _ in rows], "embedding": [v for _, v in rows]}) for _ in range(40))
    out = pa.concat_tables(V._counts_between(query, tables))
    assert out.num_rows <= 3 and sum(out["n"].to_pylist()) == 40 * 120


def test_fallback_labels(spark):
    hits = spark.createDataFrame([("a", "1", 1.0), ("b", "2", 1.0)], "query_id string, post_id string, score double")
    asked = spark.createDataFrame([("a", [1.0])], "query_id string, embedding array<float>")
    vec = spark.createDataFrame([("9", [0.5])], "post_id string, embedding array<float>")
    rows = P.search_with_fallback(hits, asked, vec, 5).collect()
    assert {(r.query_id, r.post_id, r.method) for r in rows} == {
        ("a", "1", "hybrid"), ("a", "9", "hybrid"), ("b", "2", "keyword")}
    assert ranking.topk(hits, -1).count() == 2


def test_queries_that_ask_the_same_share_a_ranking(spark, vectors):
    """Whole rankings hold a row per question and hit, not per query and hit."""
    rows, frame = vectors
    texts = [(p, " ".join(["red"] * (i % 4) + ["blue"] * (i % 3) + ["x"] * (i % 7))) for i, (p, _) in enumerate(rows)]
    index = P.build_index(spark.createDataFrame(texts, "post_id string, content string"))
    words = (["red"], ["blue", "red"], ["zzzzz"])
    asked = [(f"q{i:02d}", words[i % 3]) for i in range(30)] + [("alone", ["red"]), ("none", [])]
    queries = spark.createDataFrame(asked, "query_id string, must array<string>")
    whole, shared = P.search(queries, index, -1), P.search(queries, index, -1, shared=True)
    assert shared.hits.count() * 10 < whole.count() and shared.hits.select("question").distinct().count() == 2
    for limit in (-1, 500):
        for query_id, must in asked[:2] + asked[-2:]:
            own = spark.createDataFrame([(query_id, must)], "query_id string, must array<string>")
            got = sorted(tuple(r) for r in P.search(own, index, limit).collect())
            assert got == sorted(tuple(r) for r in whole.where(f"query_id = '{query_id}'").collect())
    near = spark.createDataFrame([(f"q{i:02d}", rows[i][1]) for i in range(30)], "query_id string, embedding array<float>")
    plain = whole.select("query_id", "post_id", "score")
    for ask in (P.hybrid_search, P.search_with_fallback):
        for n in (3, -1):
            results = [sorted(tuple(r) for r in ask(hits, near, frame, n, 5).collect()) for hits in (plain, shared)]
            assert results[0] == results[1] and results[0]


def test_postings_of_a_few_posts_at_a_time(spark, monkeypatch):
    """Slices of a batch, empty and null texts, and a field whose name sorts first."""
    posts = [("1", "b a b", "a c"), ("2", None, None), ("3", "", "b"), ("4", "a " * 7, None), (None, "ä a", "z")]
    frame = spark.createDataFrame(posts, "post_id string, title string, content string").coalesce(1)
    names, batch = ["title", "content"], pa.RecordBatch.from_pylist(
        [{"post_id": p, "t0": (t or "").split(), "t1": (c or "").split()} for p, t, c in posts],
        pa.schema([("post_id", pa.string()), ("t0", pa.list_(pa.string())), ("t1", pa.list_(pa.string()))]),
    )
    whole = [tuple(r) for r in P.build_postings(frame, names, fold=False).collect()]
    assert whole[:4] == [
        ("a", "content", "1", 1, 5, True, [0]), ("a", "title", "1", 1, 5, False, [1]),
        ("b", "title", "1", 2, 5, True, [0, 2]), ("c", "content", "1", 1, 5, True, [1]),
    ]
    assert [r[:6] for r in whole[4:6]] == [("b", "content", "3", 1, 1, True), ("a", "title", "4", 7, 7, True)]
    for size in (1, 6, 100):
        monkeypatch.setattr(T, "TOKENS_AT_A_TIME", size)
        parts = list(T._runs(batch, names))
        assert [tuple(r.values()) for part in parts for r in part.to_pylist()] == whole
        assert len(parts) == {1: 4, 6: 3, 100: 1}[size]


def test_an_index_is_laid_out_part_by_part(spark, tmp_path, monkeypatch):
    """Postings take several times their size in a shuffle, so no more than a part of them is in one."""
    rows = spark.createDataFrame(documents(), "post_id string, content string, title string")
    paths, save = [], T.save
    monkeypatch.setattr(T, "PART_ROWS", 10, raising=False)
    monkeypatch.setattr(T, "save", lambda df, path, *a: (paths.append(path), save(df, path, *a)))
    P.write_index(P.build_postings(rows, FIELDS), rows, str(tmp_path / "index"), buckets=11, fields=FIELDS)
    assert sum("/postings/" in p for p in paths) == T.PARTS > 1
    index = P.read_index(spark, str(tmp_path / "index"))
    assert sorted(P.live_postings(index).collect()) == sorted(P.build_postings(rows, FIELDS).collect())
    assert {r.bucket for r in index.postings.select("bucket").distinct().collect()} <= set(range(11))


def test_phrases_are_looked_for_where_their_rarest_words_are(spark, tmp_path, monkeypatch):
    """Postings of common words are shuffled for the posts that hold the rare ones only, and hits
    are the same if the places are too many to send."""
    texts = [f"the of in w{i}" for i in range(300)] + ["zebra of the in", "of the zebra in the of", "zebra", "in of the zebra the"]
    rows = spark.createDataFrame([(f"{i:03d}", t) for i, t in enumerate(texts)], "post_id string, content string")
    P.write_index(P.build_postings(rows), rows, str(tmp_path / "index"))
    index = P.read_index(spark, str(tmp_path / "index"))
    queries = search_table(spark, {"query_id": "p", "phrase": ["of the zebra"]}, {"query_id": "n", "near": ["zebra", "of", "in"], "near_k": 2},
                           {"query_id": "c", "initial": ["the of"]})
    units = S.query_units(queries)
    asked = S._Asked(units.where("query_id <> 'c'"), index)
    places = S._places(index, asked.terms)
    assert {(r.query_id, r.post_id) for r in places.collect()} == {(q, p) for q in "pn" for p in ("300", "301", "303")}
    plan = places._jdf.queryExecution().executedPlan().toString()
    counted = S._candidates(index, asked.terms).count()
    assert counted == 6 and "BroadcastHashJoin [place" in plan
    few = sorted(S.search(queries, index, 10).collect())
    monkeypatch.setattr(S, "MAX_BROADCAST_PLACES", 0)
    assert sorted(S.search(queries, index, 10).collect()) == few
    assert {(r.query_id, r.post_id) for r in few if r.query_id != "c"} == {("p", "301"), ("p", "303"), ("n", "300"), ("n", "301"), ("n", "303")}
    assert sum(r.query_id == "c" for r in few) == 10
