import hashlib
import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from samples import HARD

from postlake.llm import queries as Q, runs as R


def brute(words):
    """Runs by the definition: for every period the maximal stretches, if no smaller one fits."""
    n, found = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            smallest = not any(all(words[x] == words[x + p] for x in range(i, i + length - p)) for p in range(1, q))
            if smallest and length >= max(6, 4 * q):
                found.append((i, length, q))
            i = j
    return sorted(found, key=lambda r: (r[0], r[2]))


def kept_words(words, runs):
    return [w for i, w in enumerate(words) if not any(s + q <= i < s + length for s, length, q in runs)]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.lists(st.sampled_from("abc"), min_size=1, max_size=9), st.integers(1, 7)), max_size=6))
def test_runs_of_repeated_blocks(blocks):
    words = [w for block, times in blocks for w in block * times]
    got = R.text_runs([" ".join(words).encode(), None, " ".join(words).encode()])
    for own, runs, kept in (got[0], got[2]):
        assert [tuple(r) for r in runs.tolist()] == brute(words)
        assert [w.decode() for w, k in zip(own, kept) if k] == kept_words(words, brute(words))
    assert len(got[1][0]) == len(got[1][1]) == 0


def test_long_periods_and_long_texts():
    rng = np.random.default_rng(3)
    period = [f"w{i}" for i in rng.integers(0, 40, 700)]
    words = ["x"] * 50_000 + period * 5 + period[:123] + ["y", "z"] * 5
    [(_, runs, kept)] = R.text_runs([" ".join(words).encode()])
    assert [tuple(r) for r in runs.tolist()] == [(0, 50_000, 1), (50_000, 3623, 700), (53_623, 10, 2)]
    assert kept.sum() == 1 + 700 + 2


def planted(doc_id, text):
    words = (text or "").encode().split()
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 == 0:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    return words


def expected(doc_id, text):
    words = planted(doc_id, text)
    runs = brute(words)
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
    sha = lambda data: hashlib.sha256(data).hexdigest()
    return (
        doc_id, len(runs), *(best or (None, None, None)), best and 1000 * best[1] // best[2],
        sha("".join(f"{s},{length},{q}\n" for s, length, q in runs).encode()), sha(b" ".join(kept_words(words, runs))),
    )


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_query_equals_brute_force(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").where("length(text) < 3000")
    ids = [i for i in range(100_000) if zlib.crc32(str(i).encode()) % 10 == 0][:25]
    texts = [r.text for r in docs.where("length(text) > 30").orderBy("doc_id").limit(25).collect()]
    more = [(i, t) for i, t in zip(ids, texts)] + [(7, "a b " * 40), (7, "A a " * 9), (8, " x " * 7), (None, "z " * 9), (ids[0], " ")]
    rows = docs.union(spark.createDataFrame(more, docs.schema))
    rows.write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r[c] for c in COLUMNS) for r in Q.op12_periodic_runs(spark, str(tmp_path)).collect()]
    want = [expected(r.doc_id, r.text) for r in rows.collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert sum(r[1] > 0 for r in want) > 15


def test_hard_rows(spark, hard, empty):
    frame = hard.withColumnRenamed("source", "runs")
    rows = R.periodic_runs(frame).collect()
    assert len(rows) == len(HARD) and R.periodic_runs(empty).count() == 0
    assert all(r.collapsed.encode().split() == (r.text or "").encode().split() for r in rows if not r.runs)
    long = next(r for r in rows if r.doc_id == 11)
    assert [tuple(x) for x in long.runs] == [(0, 60_000, 5000)] and len(long.collapsed.split()) == 5000
    assert R.periodic_runs(frame).columns == ["doc_id", "text", "lang", "n_chars", "n_words", "runs", "collapsed"]


@pytest.mark.parametrize("n", [3, 5, 6])
def test_least_length(n):
    [(_, runs, _)] = R.text_runs([b"a " * n])
    assert len(runs) == (n >= 6)
