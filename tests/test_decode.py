"""Decoding: missing, wrong and empty values, dates, arrival order."""

import datetime as dt
import json

import pytest

import postlake as P
from postlake.functions.times import day_text, minute_text, month_text, parse_post_time, time_text
from pyspark.sql import functions as F


def raw(spark, *items):
    rows = [(0, 0, i, item if isinstance(item, str) else json.dumps(item)) for i, item in enumerate(items)]
    return spark.createDataFrame(rows, "sequence bigint, chunk int, pos int, item_json string")


def item(legacy=None, **payload):
    return {"id": "item", "payload": {"rest_id": "1", "legacy": {"full_text": "text", **(legacy or {})}, **payload}}


def one(spark, value):
    posts, _ = P.decode_items(raw(spark, value))
    rows = posts.collect()
    assert len(rows) == 1
    return rows[0]


def test_items_without_objects_are_dropped(spark):
    items = [
        {"id": "a"}, {"id": "b", "payload": "text"}, {"id": "c", "payload": {"rest_id": "3"}},
        {"id": "d", "payload": {"rest_id": "4", "legacy": []}}, "no json at all",
        {"payload": {"rest_id": "", "legacy": {"id_str": None}}},
    ]
    posts, rejects = P.decode_items(raw(spark, *items))
    assert posts.count() == 0 and rejects.count() == 0


def test_id_is_first_truthy(spark):
    cases = [
        ({"id": "x", "payload": {"rest_id": "", "legacy": {"id_str": "7"}}}, "7"),
        ({"id": "x", "payload": {"rest_id": 0, "legacy": {"id_str": False}}}, "x"),
        ({"id": "x", "payload": {"rest_id": "0", "legacy": {"id_str": "7"}}}, "0"),
        ({"id": 5, "payload": {"legacy": {}}}, "5"),
        ({"id": "x", "payload": {"rest_id": 12345678901234567, "legacy": {}}}, "12345678901234567"),
    ]
    for value, expected in cases:
        assert one(spark, value).post_id == expected


def note(text):
    return {"note_tweet": {"note_tweet_results": {"result": {"text": text}}}}


def test_text_choice(spark):
    cases = [
        (item({"full_text": "short"}, **note(" long \n")), "long"),
        (item({"full_text": "short"}, **note("  \t")), "short"),
        (item({"full_text": "short"}, **note(7)), "short"),
        (item({"full_text": "", "text": " b "}), "b"),
        (item({"full_text": "   ", "text": "b"}), ""),
        (item({"full_text": None}), ""),
        (item({"full_text": "&amp; stays"}), "&amp; stays"),
    ]
    for value, expected in cases:
        assert one(spark, value).content == expected


def test_flags(spark):
    cases = [
        ({"retweeted_status_result": {}}, (0, 0, 0, None)),
        ({"retweeted_status_result": {"a": 1}}, (0, 1, 0, None)),
        ({"full_text": "RT @x hello"}, (0, 1, 0, None)),
        ({"in_reply_to_status_id_str": ""}, (0, 0, 0, None)),
        ({"in_reply_to_status_id_str": "9", "is_quote_status": True}, (1, 0, 1, "9")),
        ({"is_quote_status": "false"}, (0, 0, 1, None)),
        ({"is_quote_status": 0}, (0, 0, 0, None)),
    ]
    for legacy, expected in cases:
        row = one(spark, item(legacy))
        assert (row.is_reply, row.is_repost, row.is_quote, row.reply_to_post_id) == expected


def test_counts(spark):
    row = one(spark, item({"favorite_count": 3.9, "retweet_count": None, "reply_count": "12"}, views={"count": "88"}))
    assert (row.like_count, row.repost_count, row.reply_count, row.view_count) == (3, 0, 12, 88)
    row = one(spark, item({"favorite_count": True}, views="bad"))
    assert (row.like_count, row.view_count) == (1, 0)


def test_unreadable_rows_are_rejected(spark):
    items = [item({"created_at": "yesterday"}), item({"favorite_count": "many"}), item({"created_at": 12}), item()]
    posts, rejects = P.decode_items(raw(spark, *items))
    assert posts.count() == 1
    assert sorted(r.problem for r in rejects.collect()) == ["created_at", "created_at", "like_count"]


@pytest.mark.parametrize("text, expected", [
    ("Sat Sep 27 19:32:11 +0000 2025", "2025-09-27T19:32:11+00:00"),
    ("Sat, 27 Sep 2025 19:32:11 +0230", "2025-09-27T17:02:11+00:00"),
    ("27 Sep 2025 19:32:11 -0700", "2025-09-28T02:32:11+00:00"),
    ("27 Sep 2025 19:32:11", "2025-09-27T19:32:11+00:00"),
    ("27 Sep 2025 19:32 GMT", "2025-09-27T19:32:00+00:00"),
    ("Sat, 27 Sep 2025 19:32:11 EST", "2025-09-28T00:32:11+00:00"),
    ("Sep 27 19:32:11 2025", "2025-09-27T19:32:11+00:00"),
    ("30 Feb 2025 10:00:00", ""),
    ("soon", ""),
])
def test_dates(spark, text, expected):
    frame = spark.createDataFrame([(text,)], "t string").select(time_text(parse_post_time(F.col("t"))).alias("t"))
    assert frame.head().t == expected


def test_dates_do_not_depend_on_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        row = one(spark, item({"created_at": "Sun Nov 02 05:30:00 +0000 2025"}))
        assert row.created_at == dt.datetime(2025, 11, 2, 5, 30)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_time_texts(spark):
    rows = [(dt.datetime(2025, 3, 9, 2, 30),), (dt.datetime(2025, 3, 9, 2, 30, 1, 500000),), (None,)]
    frame = spark.createDataFrame(rows, "t timestamp_ntz")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = [tuple(r) for r in frame.select(*[f(F.col("t")) for f in (time_text, day_text, minute_text, month_text)]).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == [
        ("2025-03-09T02:30:00+00:00", "2025-03-09", "2025-03-09T02:30", "2025-03"),
        ("2025-03-09T02:30:01.500000+00:00", "2025-03-09", "2025-03-09T02:30", "2025-03"),
        ("", "", "", ""),
    ]


def test_last_arrival_wins(spark):
    rows = [
        (1, 0, 0, json.dumps(item({"favorite_count": 5}))), (0, 0, 9, json.dumps(item({"favorite_count": 4}))),
        (1, 0, 2, json.dumps(item({"favorite_count": 7}))), (1, 0, 1, json.dumps(item({"favorite_count": 6}))),
    ]
    frame = spark.createDataFrame(rows, "sequence bigint, chunk int, pos int, item_json string")
    assert [r.like_count for r in P.dedupe_last(P.decode_items(frame)[0]).collect()] == [7]


def test_item_is_parsed_once_and_dedupe_limits_groups_before_the_shuffle(spark):
    plan = P.dedupe_last(P.decode_items(raw(spark, item()))[0])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1
    assert plan.count("WindowGroupLimit") == 2


def test_dump_reading(spark, tmp_path):
    page = {"ok": True, "data": {"result": {"chunks": [
        {"sequence": 4, "items": [item(), {"id": "z"}]}, {"items": [item()]}]}}}
    (tmp_path / "a.txt").write_text("log line\n" + json.dumps(page) + "\n")
    rows = P.read_raw_items(spark, str(tmp_path)).collect()
    assert sorted((r.sequence, r.chunk, r.pos) for r in rows) == [(0, 1, 0), (4, 0, 0), (4, 0, 1)]
    assert any(json.loads(r.item_json) == {"id": "z"} for r in rows)
    (tmp_path / "b.txt").write_text('{"ok": false, "error": "x"}\n')
    with pytest.raises(Exception, match="not ok"):
        P.read_raw_items(spark, str(tmp_path)).collect()
