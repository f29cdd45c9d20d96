import random
from collections import Counter

from pyspark.sql import functions as F
from samples import HARD

from postlake.llm import quality as Q


def brute(text):
    words = (text or "").encode().split()
    windows = list(zip(words, words[1:], words[2:]))
    often = Counter(windows)
    covered = {i + j for i, w in enumerate(windows) if often[w] > 1 for j in range(3)}
    lines = [line for line in (text or "").split("\n") if line.encode().split()]
    return (len(words), sum(len(w.decode()) for w in words), sum((text or "").count(c) for c in "#*$%&|<>"),
            len(lines) - len(set(lines)), len(covered))


def test_measures_of_hard_rows(spark, hard):
    rows = Q.quality_rules(hard.withColumnRenamed("n_chars", "n_words")).select(
        "doc_id", "text", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept").collect()
    assert len(rows) == len(HARD)
    for row in rows:
        want = brute(row.text)
        assert tuple(row)[2:7] == want
        assert row.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (row.base_failed and row.kept)


def test_repeats_overlap(spark):
    text = "a b c d a b c x a b c d e e e e e"
    got = Q.measure(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert got.n_repeat_words == brute(text)[4]


def test_policies_and_ablations(spark):
    rows = spark.createDataFrame([(1, 0), (2, 1), (3, 3), (4, 2), (5, 4)], "doc_id long, fail_bits long")
    kept = Q.apply_policies(rows, Q.POLICIES).orderBy("doc_id").collect()
    assert [r.kept_base_v1 for r in kept] == [True, False, False, False, True]
    assert [r.kept_standard_v2 for r in kept] == [True, False, False, False, False]
    got = {r.rule: tuple(r)[1:] for r in Q.ablations(rows, Q.BASE).collect()}
    # failed, failed alone, kept without
    assert got == {"few_words": (2, 1, 3), "repeated_words": (2, 1, 3)}


def test_filter_on_ledger_does_not_repeat_measurements(spark, hard):
    assert Q.quality_rules(hard).where("kept").select("doc_id").count() >= 0


def test_empty(spark, empty):
    assert Q.quality_rules(empty).count() == 0
    assert Q.ablations(Q.ledger(empty), Q.STANDARD).count() == 0


def test_clashing_names_pass_through(spark, hard):
    names = ["_words", "_lines", "_windows", "_WORDS_", "starts", "placed", "_starts"]
    rows = Q.quality_rules(hard.select("*", *[F.lit(n).alias(n) for n in names])).collect()
    assert all([r[n] for n in names] == names and r.n_words == brute(r.text)[0] for r in rows)


def test_text_of_a_million_words(spark):
    """Windows keep whole hashes however long the text."""
    rng = random.Random(1)
    words = [f"{rng.randrange(1 << 40):x}" for _ in range(1_000_000)]
    words[900_000:900_003] = words[5:8]
    rows = spark.createDataFrame([(1, " ".join(words))], "doc_id long, text string")
    assert Q.measure(rows).first().n_repeat_words == 6


def test_stored_ledger_serves_policies_without_texts(spark, hard, tmp_path):
    Q.write_ledger(Q.ledger(hard), f"{tmp_path}/ledger")
    stored = Q.read_ledger(spark, f"{tmp_path}/ledger")
    assert "text" not in stored.columns and stored.count() == len(HARD)
    direct = Q.apply_policies(Q.ledger(hard), Q.POLICIES)
    again = Q.apply_policies(stored, Q.POLICIES)
    kept = [f"kept_{p.name}_v{p.version}" for p in Q.POLICIES]
    rows = lambda f: sorted(map(tuple, f.select("doc_id", *kept).collect()), key=repr)
    assert rows(direct) == rows(again)
    plan = again._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema" in plan and "text" not in plan
    bits = [r.fail_bits & Q.STANDARD.mask() for r in stored.collect()]
    for r in Q.ablations(stored, Q.STANDARD).collect():
        bit = 1 << next(x.bit for x in Q.RULES if x.name == r.rule)
        assert tuple(r)[1:] == (sum(b & bit > 0 for b in bits), sum(b == bit for b in bits), sum(b & ~bit == 0 for b in bits))
