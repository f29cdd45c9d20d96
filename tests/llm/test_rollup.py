import pytest
from pyspark.sql import functions as F

from postlake.llm import rollup as R
from postlake.session import scratch_path

CHANGES = "doc_id long, action string, text string, source string, lang string, pos int, extra string"


def state(spark, store, until=None):
    rows = R.totals(spark, store, until).where("tokenizer = 'words@1'").collect()
    return {(r.source, r.lang): (r.n_docs, r.n_tokens) for r in rows}


def test_signed_deltas_and_replays(spark):
    store = scratch_path(spark, "store")
    first = spark.createDataFrame([
        (1, "insert", "a b c", "s", "en", 0, None), (2, "insert", None, "s", None, 0, None), (3, "insert", "d", None, "en", 0, None),
        (None, "insert", "x y", "s", "en", 0, None),
    ], CHANGES)
    second = spark.createDataFrame([
        (1, "revise", "a b c d e", "s", "en", 1, None), (1, "revise", "a", "t", "en", 2, None), (3, "delete", "", "zzz", "zz", 0, None),
        (9, "delete", "q", "s", "en", 0, None), (4, "insert", "\x0b \t", "s", "en", 0, None),
    ], CHANGES)
    assert R.commit_batch(spark, store, 1, first)
    assert state(spark, store) == {("s", "en"): (2, 5), ("s", None): (1, 0), (None, "en"): (1, 1)}
    assert R.commit_batch(spark, store, 2, second)
    after = {("s", "en"): (2, 2), ("t", "en"): (1, 1), ("s", None): (1, 0)}
    assert state(spark, store) == after
    assert not R.commit_batch(spark, store, 1, first) and not R.commit_batch(spark, store, 2, second)
    assert state(spark, store) == after and state(spark, store, until=1)[("s", "en")] == (2, 5)


def test_half_written_batch_is_run_again(spark):
    store = scratch_path(spark, "store")
    one = spark.createDataFrame([(1, "insert", "a b", "s", "en", 0, None)], CHANGES)
    # Its ledger is there, its deltas are not.
    R._counted(one, R.TOKENIZERS).write.parquet(f"{store}/ledger/seq=1")
    assert state(spark, store) == {}
    assert R.commit_batch(spark, store, 1, one)
    assert state(spark, store) == {("s", "en"): (1, 2)}


def test_new_tokenizer_version(spark):
    store = scratch_path(spark, "store")
    one = spark.createDataFrame([(1, "insert", "a b", "s", "en", 0, None)], CHANGES)
    R.commit_batch(spark, store, 1, one)
    R.commit_batch(spark, store, 2, one, {"words@2": lambda text: F.length(text).cast("bigint")})
    got = {r.tokenizer: r.n_tokens for r in R.totals(spark, store).collect()}
    assert got == {"words@1": 2, "bytes@1": 3, "pieces@1": 2, "words@2": 3}


def test_unknown_action_and_empty(spark):
    store = scratch_path(spark, "store")
    with pytest.raises(Exception, match="unknown action"):
        R.commit_batch(spark, store, 1, spark.createDataFrame([(1, "upsert", "a", "s", "en", 0, None)], CHANGES))
    assert R.commit_batch(spark, store, 1, spark.createDataFrame([], CHANGES))
    assert R.totals(spark, store).count() == 0


def test_batches_out_of_order(spark):
    """Any order of arrival gives the totals of the order of numbers, as of every batch."""
    batches = {
        1: [(1, "insert", "a b c", "s", "en", 0, None), (2, "insert", "a", "s", "en", 0, None)],
        2: [(1, "revise", "a b c d e", "t", "en", 0, None), (3, "insert", "x y", "s", "en", 0, None), (2, "delete", "", "s", "en", 0, None)],
        3: [(1, "revise", "a", "s", "en", 0, None), (3, "delete", "", "s", "en", 0, None)],
        4: [(1, "delete", "", "s", "en", 0, None), (2, "insert", "q q q", "u", "en", 0, None), (3, "insert", "z", "s", "en", 0, None)],
    }
    frames = {n: spark.createDataFrame(rows, CHANGES) for n, rows in batches.items()}
    states = []
    for order in ((1, 2, 3, 4), (1, 4, 2, 3)):
        store = scratch_path(spark, "store")
        for n in order:
            assert R.commit_batch(spark, store, n, frames[n])
        states.append([state(spark, store, until) for until in (1, 2, 3, 4, None)])
    assert states[0] == states[1]
    assert states[0][4] == {("u", "en"): (1, 3), ("s", "en"): (1, 1)}
