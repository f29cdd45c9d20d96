"""Archive semantics: figures, top lists, joins, updates, corpus, stream and SQL."""

import datetime as dt
import json

import pytest

import postlake as P
from postlake.operators.incremental import NO_BOUND
from postlake.operators.joins import MAX_BROADCAST_HITS
from postlake.schemas import POSTS
from postlake.sources import archive as A
from postlake.sources.archive import current_version
from postlake.sources.archive import VersionError
from postlake.streaming.ingest import EmptyBatchError, GapError, rejects_dir
from pyspark.sql import functions as F


def day(n):
    return dt.datetime(2025, 9, 1) + dt.timedelta(days=n)


def post(post_id, created=0, content="text", likes=1, reposts=0, replies=0, views=5, reply=0, repost=0, quote=0, to=None):
    when = None if created is None else day(created)
    return (post_id, content, when, likes, reposts, replies, views, reply, repost, quote, to)


def make(spark, *rows):
    return spark.createDataFrame(list(rows), POSTS)


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def few(spark):
    return make(
        spark,
        post("1", 1, "Hello 100% World", likes=10, views=None),
        post("2", 1, "second", likes=30, reply=1, to="1"),
        post("3", None, None, likes=30, views=0),
        post("4", 9, "RT @x hello", likes=99, reply=1, repost=1),
    )


def test_figures(spark, few):
    row = P.archive_stats(few).head()
    assert (row.total, row.original, row.replies, row.reposts) == (4, 2, 2, 1)
    assert row.avg_likes == 23.3 and row.avg_views == 3.0
    assert (row.earliest, row.latest) == (day(1), day(9))
    none = few.limit(0)
    assert P.archive_stats(none).head().original == 0
    assert P.archive_summary(none).head().original is None
    assert plan(P.archive_stats(few)).count("Scan") == 1


def test_top_and_recent(spark, few):
    assert [r.post_id for r in P.top(few).collect()] == ["2", "3", "1"]
    assert [r.post_id for r in P.top(few, "no such metric", 1).collect()] == ["2"]
    assert [r.post_id for r in P.top(few, "views", -1).collect()] == ["2", "3", "1"]
    assert [r.post_id for r in P.recent(few, -1).collect()] == ["1", "2", "3"]
    assert "TakeOrderedAndProject" in plan(P.top(few, n=2))
    assert "repost_count" in P.top(few).columns and "repost_count" not in P.recent(few).columns


def test_filters(spark, few):
    assert [r.post_id for r in P.filter_contains(few, "HELLO 100%").collect()] == ["1"]
    assert P.filter_contains(few, "1_0", -1).count() == 0
    assert [r.post_id for r in P.filter_min(few, "like_count", 10).collect()] == ["4", "2", "3"]
    assert P.filter_kind(few, "reply").count() == 2


def test_enriched_hits_keep_matched_nulls(spark, few):
    hits = spark.createDataFrame(
        [("3", 0.5, "<b>x</b>"), ("404", 0.2, "<i>a</i> &amp;lt;b&gt;"), ("1", None, None)],
        "post_id string, score double, snippet string")
    rows = {r.post_id: r for r in P.enrich_hits(hits, few, max_hits=3).collect()}
    assert rows["3"].content is None and rows["3"].created_at == "" and rows["3"].view_count == 0
    assert rows["404"].content == "a &lt;b>" and rows["404"].like_count == 0 and rows["404"].created_at == ""
    assert rows["1"].view_count is None and rows["1"].score == 0.0
    assert P.join_hits(hits, few).count() == 2


def test_posts_are_not_shuffled_for_bounded_hits(spark, few, tmp_path):
    few.write.parquet(str(tmp_path / "p"))
    posts = P.read_posts(spark, str(tmp_path / "p"))
    hits = spark.range(3).selectExpr("CAST(id AS STRING) AS post_id", "1.0D AS score").repartition(2, "score")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" in plan(P.join_hits(hits, posts, max_hits=3))
        assert "BroadcastHashJoin" not in plan(P.join_hits(hits, posts, max_hits=MAX_BROADCAST_HITS + 1))
        assert "BroadcastHashJoin" not in plan(P.join_hits(hits, posts))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in plan(P.lookup_ids(posts, spark.range(2).selectExpr("CAST(id AS STRING) AS post_id")))


def test_late_rule(spark, few):
    batch = make(spark, post("1", 0), post("5", 8), post("6", 9), post("7", None), post("8", 10))
    kept, late = P.late_filter(batch, few)
    assert {r.post_id for r in kept.collect()} == {"1", "6", "8"}
    assert {r.post_id for r in late.collect()} == {"5", "7"}
    assert P.late_filter(batch, few.limit(0))[1].count() == 0
    assert P.late_filter(batch, few.where("created_at IS NULL"))[1].count() == 0
    assert {r.post_id for r in P.late_filter(batch, few, day(8))[1].collect()} == {"7"}
    assert P.late_filter(batch, few, NO_BOUND)[1].count() == 0


def test_changes_and_upsert(spark, few):
    batch = make(spark, post("1", 1, "Hello 100% World", likes=10, views=None), post("2", 1, None, likes=30), post("9", 9))
    changes = {r.post_id: r.change for r in P.classify_changes(batch, few).collect()}
    assert changes == {"1": "unchanged", "2": "updated", "9": "inserted"}
    once = P.upsert(few, batch)
    assert {r.post_id: r.content for r in once.collect()}["2"] is None
    assert sorted(map(str, P.upsert(once, batch).collect())) == sorted(map(str, once.collect()))
    counts = {r.change: r.n_rows for r in P.change_counts(P.classify_changes(batch, few)).collect()}
    assert counts == {"unchanged": 1, "updated": 1, "inserted": 1}


def test_gap(spark, few):
    status, allowed = P.gap_check(make(spark, post("50", 10)), few)
    assert status.head().status == "gap" and allowed.count() == 0
    status, allowed = P.gap_check(make(spark, post("50", 10)), few.limit(0))
    assert status.head().status == "ok" and allowed.count() == 1
    status, allowed = P.gap_check(make(spark, post("50", 10), post("1", 1)), few)
    assert status.head().status == "ok" and allowed.count() == 2


def test_report(spark, few):
    batch = make(spark, post("1", 1, "new text"), post("5", 2), post("6", 10))
    after = P.upsert(few, P.late_filter(batch, few)[0])
    corpus = P.corpus_diff_counts(P.corpus_diff(P.render_body(after), P.render_body(few)))
    row = P.update_report(few, batch, after, corpus).head()
    assert (row.n_posts, row.applied, row.n_late) == (3, 2, 1)
    assert row.db.asDict() == {"inserted": 1, "updated": 1, "unchanged": 0}
    assert row.corpus.asDict() == {"files": 4, "written": 2, "removed": 0}
    assert row.archive.total == 5 and row.overlaps and row.newest_before == day(9)


def test_corpus_round_trip(spark, few, tmp_path):
    rendered = P.render_body(few)
    assert {r.file_name: r.body for r in rendered.collect()}["3.txt"] == " | 30 likes\n\n\n"
    for row in rendered.collect():
        (tmp_path / row.file_name).write_text(row.body)
    (tmp_path / "notes.md").write_text("not a document")
    rows = {r.post_id: r for r in P.read_corpus(spark, str(tmp_path)).collect()}
    assert rows.keys() == {"1", "2", "3"}
    assert (rows["1"].post_date, rows["1"].like_count, rows["1"].content) == (day(1).date(), 10, "Hello 100% World")
    assert rows["3"].post_date is None and rows["3"].content == ""
    P.write_corpus(few, str(tmp_path / "out"))
    stored = P.read_rendered(spark, str(tmp_path / "out"))
    assert P.corpus_diff_counts(P.corpus_diff(rendered, stored)).head() == (3, 0, 0)
    assert P.corpus_diff_counts(P.corpus_diff(rendered.where("post_id = '1'"), stored)).head() == (1, 0, 2)
    assert P.corpus_diff_counts(P.corpus_diff(rendered, stored.limit(0))).head() == (3, 3, 0)


def test_checks(spark, few):
    bad = few.unionByName(make(
        spark, post("1"), post(None), post("x", quote=2), post("y", likes=-1), post("z", reply=1)))
    found = {r.rule: r.n_bad for r in P.archive_check(bad).collect()}
    assert found == {"null_id": 1, "flag_not_0_or_1": 1, "negative_count": 1, "reply_without_target": 2, "duplicate_id": 1}


def test_versions(spark, few, tmp_path):
    path = str(tmp_path / "archive")
    assert current_version(spark, path) is None
    P.write_posts(few, path, "a", clustered=True)
    P.write_posts(P.upsert(P.read_posts(spark, path), make(spark, post("9", 9))), path, "b")
    assert current_version(spark, path) == "b" and P.read_posts(spark, path).count() == 5
    with pytest.raises(ValueError):
        P.write_posts(P.read_posts(spark, path), path, "b")
    (tmp_path / "archive" / "_current" / "0000000003").mkdir()
    assert current_version(spark, path) == "b", "a pointer that was not committed does not count"


def files_of(folder):
    return {f for f in folder.rglob("*.parquet")}


def test_updates_rewrite_only_the_ranges_they_touch(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(A, "RANGE_ROWS", 10)
    path = str(tmp_path / "archive")
    first = make(spark, *[post(f"{i:04d}", i % 50, likes=i) for i in range(100, 200)])
    P.write_posts(first, path, "v1", clustered=True)
    _, ranges = A._current(spark, path)
    assert len(ranges) == 10 and ranges[0].low == "" and sum(r.rows for r in ranges) == 100
    before = files_of(tmp_path)
    # New ids: the newest range is written anew, in pieces.
    new = make(spark, *[post(f"{i:04d}", 60, likes=i) for i in range(200, 225)])
    P.write_changes(spark, path, "v2", new, base="v1")
    assert before <= files_of(tmp_path)
    _, after = A._current(spark, path)
    assert set(ranges[:-1]) <= set(after) and len(after) > 10 and not ranges[-1] in after
    assert P.read_posts(spark, path).count() == 125 and A.archive_newest(spark, path) == day(60)
    # Nothing changes: a new version of the same folders.
    now = files_of(tmp_path)
    P.write_changes(spark, path, "v3", new.limit(0), base="v2")
    assert files_of(tmp_path) == now and A._current(spark, path)[1] == after and current_version(spark, path) == "v3"
    # Known ids, ids between ranges, before the first and without value.
    some = make(spark, post("0105", 1, "other"), post("0149x", 1), post("", 1), post("zz", 1), post(None, 2))
    P.write_changes(spark, path, "v4", some)
    got = sorted(map(str, P.read_posts(spark, path).collect()))
    assert got == sorted(map(str, P.upsert(first.unionByName(new), some).collect()))
    _, final = A._current(spark, path)
    for i, r in enumerate(final):
        ids = [x.post_id or "" for x in A._read_folders(spark, path, [r.folder]).select("post_id").collect()]
        assert all(r.low <= x and (i + 1 == len(final) or x < final[i + 1].low) for x in ids) and len(ids) == r.rows
    near = P.read_posts_near(spark, path, some.where("post_id = '0105'"))
    assert near.where("post_id = '0105'").head().content == "other" and near.count() <= 20


def test_no_range_is_written_from_more_than_so_many_bytes(spark, tmp_path, monkeypatch):
    """One task sorts all of a range, so long texts make more ranges than short ones."""
    monkeypatch.setattr(A, "RANGE_BYTES", 1_000, raising=False)
    path = str(tmp_path / "archive")
    first = make(spark, *[post(f"{i:04d}", 1, "x" * 100) for i in range(100)])
    P.write_posts(first, path, "v1", clustered=True)
    _, ranges = A._current(spark, path)
    assert len(ranges) == 10 and sum(r.size for r in ranges) == 10_000
    # Pointers written before sizes were kept have none.
    A._publish(spark, path, "v2", [r._replace(size=None) for r in ranges], "v1")
    more = make(spark, *[post(f"0099{i:02d}", 1, "y" * 100) for i in range(50)], post("zz", 1, None))
    P.write_changes(spark, path, "v3", more, base="v2")
    _, after = A._current(spark, path)
    assert len(after) >= 14 and after[:9] == [r._replace(size=None) for r in ranges[:9]]
    assert P.read_posts(spark, path).count() == 151
    # A whole version is split by its first update.
    P.write_posts(first, str(tmp_path / "whole"), "v1")
    P.write_changes(spark, str(tmp_path / "whole"), "v2", more)
    assert len(A._current(spark, str(tmp_path / "whole"))[1]) >= 15


def test_an_update_goes_through_slices_of_ids(spark, tmp_path, monkeypatch):
    """What is staged and shuffled at a time is a slice, also of an archive that is one range, and
    nothing staged stays."""
    import os

    from postlake.session import shared_dir
    from postlake.streaming import ingest

    monkeypatch.setattr(A, "RANGE_BYTES", 1_000)
    monkeypatch.setattr(A, "SLICES", 4, raising=False)
    archive, inbox, taken = str(tmp_path / "archive"), str(tmp_path / "inbox"), []
    first = make(spark, *[post(f"{i:04d}", 1, "x" * 100) for i in range(100, 140)], post("0200", 1, "x" * 100, views=0))
    P.write_posts(first, archive, "v1")
    dump(tmp_path / "inbox", "a.txt", 0, ("0090", "y", day(0), 3), *[(f"{i:04d}", "y", day(1), 3) for i in (101, 103, 131, 138)], ("0139x", "new", day(2), 1), ("0200", "x" * 100, day(1), 1))
    whole, files = ingest.stage, set(os.listdir(shared_dir(spark)))

    def stage(rows, name, **more):
        staged = whole(rows, name, **more)
        taken.extend([staged.count()] * (name == "judged"))
        return staged

    monkeypatch.setattr(ingest, "stage", stage)
    P.batch_ingest(spark, inbox, archive, "v2")
    # Ids 101 and 103 lie in the first slice, 131 and after in the last, none in those between.
    assert len(taken) == 4 and sum(taken) == 7 and max(taken) < 5 and 0 in taken
    assert set(os.listdir(shared_dir(spark))) == files
    got = {r.post_id: (r.content, r.like_count) for r in P.read_posts(spark, archive).collect()}
    same = {r.post_id: (r.content, r.like_count) for r in first.collect()}
    # 0090 is late; 0200 is as it was.
    assert got == same | {i: ("y", 3) for i in ("0101", "0103", "0131", "0138")} | {"0139x": ("new", 1)}
    ranges = A._current(spark, archive)[1]
    assert P.read_posts(spark, archive).count() == 42 == sum(r.rows for r in ranges) and ranges[0].low == ""
    # Slices follow the ranges, and one without changes is kept as it is.
    dump(tmp_path / "next", "b.txt", 0, ("0101", "z", day(1), 3))
    P.batch_ingest(spark, str(tmp_path / "next"), archive, "v3")
    after = A._current(spark, archive)[1]
    assert after[-2:] == ranges[-2:] and after[0] not in ranges and len(A.archive_slices(spark, archive)) > 1
    assert {r.post_id: r.content for r in P.read_posts(spark, archive).collect()} == {i: c for i, (c, _) in got.items()} | {"0101": "z"}


def test_an_archive_that_begins_with_an_update(spark, few, tmp_path):
    path = str(tmp_path / "archive")
    P.write_changes(spark, path, "v1", few, base=None)
    assert sorted(map(str, P.read_posts(spark, path).collect())) == sorted(map(str, few.collect()))
    assert A.archive_newest(spark, path) == day(9)


def test_two_jobs_of_a_day(spark, tmp_path):
    """The later job wins whatever its sequences: by time of writing, then by name; part files
    of one write are one job."""
    import os

    folder = tmp_path / "2025-09-29"
    dump(folder, "job-a", 1, ("1", "old", day(1), 3))
    dump(folder, "job-b", 0, ("1", "new", day(1), 3))
    dump(folder, "job-c", 0, ("1", "first", day(1), 3), ("2", "same time, later name", day(1), 1))
    dump(folder, "job-b2", 5, ("2", "same time, earlier name", day(1), 1))
    for name, seconds in (("job-a", 100), ("job-b", 200), ("job-c", 50), ("job-b2", 50)):
        os.utime(folder / name, (seconds, seconds))
    got = {r.post_id: r.content for r in P.dedupe_last(P.decode_items(P.read_raw_items(spark, str(folder)))[0]).collect()}
    assert got == {"1": "new", "2": "same time, later name"}
    parts = tmp_path / "2025-09-30" / "dump"
    parts.parent.mkdir()
    dump(parts, "part-00000-x.txt", 1, ("1", "high sequence", day(1), 3))
    dump(parts, "part-00001-x.txt", 0, ("1", "low sequence", day(1), 3))
    os.utime(parts / "part-00000-x.txt", (10, 10))
    rows = P.dedupe_last(P.decode_items(P.read_raw_items(spark, f"{tmp_path}/*/*"))[0]).collect()
    assert {r.post_id: r.content for r in rows}["1"] == "high sequence"


def test_daily_update_maintains_index_and_corpus(spark, few, tmp_path):
    inbox, archive, index, corpus = (str(tmp_path / n) for n in ("inbox", "archive", "index", "corpus"))
    P.write_posts(few, archive, "start", clustered=True)
    P.write_index(P.build_postings(few), few, index)
    P.write_corpus(few, corpus)
    dump(tmp_path / "inbox", "a.txt", 0, ("1", "first words", day(1), 3), ("20", "new", day(10), 4), ("21", "late", day(2), 4),
         ("2", "RT @x gone", day(1), 30))
    row = P.daily_update(spark, inbox, archive, "v", index_dir=index, corpus_dir=corpus).head()
    posts = P.read_posts(spark, archive)
    assert (row.applied, row.n_late) == (3, 1) and row.db.asDict() == {"inserted": 1, "updated": 2, "unchanged": 0}
    assert row.corpus.asDict() == {"files": 3, "written": 2, "removed": 1}
    read = P.read_index(spark, index)
    assert sorted(P.live_postings(read).collect()) == sorted(P.build_postings(posts).collect())
    assert read.totals.head() == P.build_index(posts).totals.head()
    want = P.render_body(posts).select("post_id", "file_name", "body")
    assert sorted(P.read_rendered(spark, corpus).collect()) == sorted(want.collect())
    # An update that failed before the archive was published is run again: nothing is added twice.
    before = [len(P.published_segments(spark, index)), read.totals.head()]
    batch_changes = P.judge_batch(posts, posts, F.lit(None).cast("timestamp_ntz"))
    P.write_segment(spark, index, batch_changes, batch_changes.limit(0), "v")
    P.write_corpus_changes(spark, corpus, posts, posts.limit(0), "v")
    assert before == [len(P.published_segments(spark, index)), P.read_index(spark, index).totals.head()]
    assert P.read_rendered(spark, corpus).count() == 3


def test_sql(spark, few):
    P.register_views(few)
    rows = P.run_sql(spark, "WITH t AS (SELECT * FROM posts) SELECT post_id FROM t WHERE like_count > 20 -- note")
    assert {r.post_id for r in rows.collect()} == {"2", "3", "4"}
    for statement in ("DROP VIEW posts", "SELECT 1; DROP VIEW posts", "SET a=b", "CREATE TABLE t AS SELECT 1"):
        with pytest.raises(Exception):
            P.run_sql(spark, statement)
    assert P.run_sql(spark, "SELECT 1 AS one;").head().one == 1
    # Postings and term statistics, a join, a CTE and rows as JSON.
    P.register_views(few, P.build_index(few))
    rows = P.to_json_rows(P.run_sql(spark, """
        WITH rare AS (SELECT term, df FROM term_stats WHERE df = 1)
        SELECT p.post_id, p.like_count, r.term FROM rare r JOIN postings o ON o.term = r.term JOIN posts p ON p.post_id = o.post_id
        WHERE size(o.positions) = 1 ORDER BY r.term LIMIT 2"""))
    assert [json.loads(r.json) for r in rows.collect()] == [
        {"post_id": "1", "like_count": 10, "term": "100"}, {"post_id": "4", "like_count": 99, "term": "rt"}]
    texts = [json.loads(r.json) for r in P.to_json_rows(few.select("post_id", "content", "view_count")).collect()]
    assert {"post_id": "3", "content": None, "view_count": 0} in texts


def dump(folder, name, sequence, *posts):
    items = [
        {"id": p, "payload": {"rest_id": p, "legacy": {
            "full_text": text, "created_at": when.strftime("%a %b %d %H:%M:%S +0000 %Y"), "favorite_count": likes}}}
        for p, text, when, likes in posts
    ]
    page = {"ok": True, "data": {"result": {"chunks": [{"sequence": sequence, "items": items}]}}}
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(json.dumps(page) + "\n")


@pytest.mark.parametrize("empty", [False, True])
def test_stream_equals_batch(spark, few, tmp_path, empty):
    inbox = tmp_path / "inbox"
    dump(inbox, "a.txt", 0, ("1", "first", day(1), 3), ("20", "new", day(10), 4), ("21", "late", day(2), 4))
    dump(inbox, "b.txt", 1, ("1", "again", day(1), 5))
    for name in ("batch", "stream"):
        if not empty:
            P.write_posts(few, str(tmp_path / name), "start")
    P.batch_ingest(spark, str(inbox), str(tmp_path / "batch"), "v")
    P.stream_ingest(spark, str(inbox), str(tmp_path / "stream"), str(tmp_path / "progress")).awaitTermination()
    rows = [sorted(map(str, P.read_posts(spark, str(tmp_path / n)).collect())) for n in ("batch", "stream")]
    assert rows[0] == rows[1]
    ids = {r.post_id for r in P.read_posts(spark, str(tmp_path / "stream")).collect()}
    assert ids == ({"1", "20", "21"} if empty else {"1", "2", "3", "4", "20"})
    # The next run of the same checkpoint takes only new files and keeps the bound.
    dump(inbox, "c.txt", 2, ("30", "early", day(9), 1))
    P.stream_ingest(spark, str(inbox), str(tmp_path / "stream"), str(tmp_path / "progress")).awaitTermination()
    assert "30" in {r.post_id for r in P.read_posts(spark, str(tmp_path / "stream")).collect()}


def test_two_runs_and_a_later_dump_with_low_sequences(spark, few, tmp_path):
    archive, inbox = str(tmp_path / "archive"), tmp_path / "inbox"
    P.write_posts(few, archive, "start")
    dump(inbox, "2025-09-28-p1.txt", 1, ("1", "old", day(1), 3), ("50", "one", day(20), 1))
    P.stream_ingest(spark, str(inbox), archive, str(tmp_path / "day1")).awaitTermination()
    dump(inbox, "2025-09-29-p0.txt", 0, ("1", "new", day(1), 9), ("51", "two", day(21), 1))
    P.stream_ingest(spark, str(inbox), archive, str(tmp_path / "day2")).awaitTermination()
    got = {r.post_id: r.content for r in P.read_posts(spark, archive).collect()}
    assert got["1"] == "new" and {"50", "51"} <= set(got)
    # Both days at once: the later job wins although its sequences are lower.
    batch = P.dedupe_last(P.decode_items(P.read_raw_items(spark, str(inbox)))[0])
    assert {r.post_id: r.content for r in batch.collect()}["1"] == "new"


def test_unreadable_items_are_kept(spark, few, tmp_path):
    archive, inbox = str(tmp_path / "archive"), tmp_path / "inbox"
    P.write_posts(few, archive, "start")
    dump(inbox, "a.txt", 0, ("1", "good", day(1), 3), ("2", "bad", day(1), "many"))
    row = P.daily_update(spark, str(inbox), archive, "v").head()
    assert row.n_rejected == 1
    kept = spark.read.parquet(rejects_dir(archive, "v")).collect()
    assert [(r.post_id, r.problem) for r in kept] == [("2", "like_count")]
    P.stream_ingest(spark, str(inbox), archive, str(tmp_path / "progress")).awaitTermination()
    version = current_version(spark, archive)
    assert spark.read.parquet(rejects_dir(archive, version)).count() == 1


def test_empty_batch_is_refused(spark, few, tmp_path):
    archive, inbox = str(tmp_path / "archive"), tmp_path / "inbox"
    P.write_posts(few, archive, "start")
    dump(inbox, "a.txt", 0)
    for call in (P.batch_ingest, P.daily_update):
        with pytest.raises(EmptyBatchError):
            call(spark, str(inbox), archive, "v")
    P.stream_ingest(spark, str(inbox), archive, str(tmp_path / "progress")).awaitTermination()
    assert current_version(spark, archive) == "start"


def test_dry_run_refuses_a_gap(spark, few, tmp_path):
    archive = str(tmp_path / "archive")
    P.write_posts(few, archive, "start")
    dump(tmp_path / "inbox", "a.txt", 0, ("77", "far", day(20), 3))
    with pytest.raises(GapError):
        P.daily_update(spark, str(tmp_path / "inbox"), archive, "v", dry_run=True)


def test_two_writers(spark, few, tmp_path):
    archive = str(tmp_path / "archive")
    P.write_posts(few, archive, "v1", base=None)
    P.write_posts(few, archive, "v2", base="v1")
    with pytest.raises(VersionError, match="v2 is current"):
        P.write_posts(few, archive, "v3", base="v1")
    for old in ("v1", "v2"):
        with pytest.raises(VersionError, match="was published"):
            P.write_posts(few, archive, old)
    P.write_posts(few, archive, "v3", base="v2")
    assert current_version(spark, archive) == "v3"


def test_daily_update_reports(spark, few, tmp_path):
    inbox, archive = tmp_path / "inbox", str(tmp_path / "archive")
    dump(inbox, "a.txt", 0, ("1", "first", day(1), 3), ("20", "new", day(10), 4), ("21", "late", day(2), 4))
    P.write_posts(few, archive, "start")
    dry = P.daily_update(spark, str(inbox), archive, "v", dry_run=True).head()
    assert (dry.n_kept, dry.n_late) == (2, 1) and current_version(spark, archive) == "start"
    row = P.daily_update(spark, str(inbox), archive, "v").head()
    assert current_version(spark, archive) == "v"
    assert (row.applied, row.db.inserted, row.db.updated) == (2, 1, 1)
    assert row.corpus.asDict() == {"files": 4, "written": 2, "removed": 0} and row.archive.total == 5


def test_catch_up_refuses_a_gap(spark, few, tmp_path):
    dump(tmp_path / "inbox", "a.txt", 0, ("77", "far", day(20), 3))
    P.write_posts(few, str(tmp_path / "archive"), "start")
    with pytest.raises(GapError):
        P.batch_ingest(spark, str(tmp_path / "inbox"), str(tmp_path / "archive"), "v", catch_up=True)
    assert current_version(spark, str(tmp_path / "archive")) == "start"
