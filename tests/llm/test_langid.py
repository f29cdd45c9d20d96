import math

import numpy as np
from pyspark.sql import functions as F
from samples import HARD

from postlake.llm import langid as I



def remainder():
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = I.identify_languages(docs, remainder() != 1).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.98 * len(rows) > 0
    assert all(0 <= r.score <= 1 for r in rows)


def test_hard_rows(spark, hard):
    rows = I.identify_languages(hard, remainder() != 1).collect()
    assert len(rows) == len(HARD)
    learned = {r[2] for r in HARD if r[2]}
    for r in rows:
        if r.doc_id in (5, 6, 7, 10):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        elif r.doc_id is not None:
            assert r.lang_pred in learned and 0 < r.score <= 1


def test_labels_do_not_reach_predictions(spark, hard):
    seen = hard.withColumn("trained", F.col("doc_id") < 9)
    shuffled = seen.withColumn("lang", F.when(F.col("trained"), F.col("lang")).otherwise(F.lit("xx"))).withColumn("source", F.lit("?"))
    a, b = (sorted((r.doc_id or -1, r.lang_pred, r.score) for r in I.identify_languages(x, F.col("trained")).collect()) for x in (seen, shuffled))
    assert a == b


def test_nothing_to_learn(spark, hard, empty):
    assert {(r.lang_pred, r.score) for r in I.identify_languages(hard, F.lit(False)).collect()} == {("und", 0.0)}
    assert I.identify_languages(empty, F.lit(True)).count() == 0


def test_weights_are_sparse_and_temperature_found(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    languages, weights, temperature = I.fit(docs.where("lang is not null"))
    assert len(languages) == 4 and 0.05 <= temperature <= 20
    assert (weights == 0).mean() > 0.3


def plain_features(text):
    """Shares of hashed n-grams of one to three characters, character by character."""
    def code(c):
        if not c.isalpha():
            return 32
        return ord(c.lower()) if ord(c) <= 0xFFFF and len(c.lower()) == 1 else ord(c)

    codes, mask, found = [32, *map(code, text), 32, 32], 0xFFFFFFFF, {}
    for at in range(len(text) + 1):
        h = 0
        for order in range(3):
            h = ((h ^ codes[at + order]) * 0x9E3779B1 + order) & mask
            own = (((h ^ (h >> 15)) * 0x85EBCA77) & mask) >> 16
            found[own] = found.get(own, 0) + 1
    total = sum(found.values())
    return {f: n / total for f, n in found.items()}


def test_predictions_equal_plain_python(spark):
    """Whole texts, n-gram by n-gram, with the learned weights."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    languages, weights, temperature = I.fit(docs.where(remainder() != 1))
    got = {r.doc_id: r for r in I.identify_languages(docs, remainder() != 1).collect()}
    asked = [r for r in docs.collect() if len(r.text) < 4000][:80]
    for r in asked:
        own = plain_features(r.text)
        logits = [sum(share * weights[f, i] for f, share in own.items()) / temperature for i in range(len(languages))]
        top = max(logits)
        chances = [math.exp(x - top) for x in logits]
        best = logits.index(top)
        assert got[r.doc_id].lang_pred == languages[best]
        assert abs(got[r.doc_id].score - chances[best] / sum(chances)) < 1e-4
    assert len(asked) == 80


def test_weights_equal_plain_ftrl():
    """Follow-the-regularised-leader, one weight at a time."""
    rng = np.random.default_rng(3)
    rows = [(int(c), np.array([c, 3 + c, 7]), np.array([0.5, 0.3, 0.2])) for c in rng.integers(0, 3, 30)]
    idf = np.ones(I.FEATURES)
    got, temperature = I.train(rows, idf, 3)
    z, n = {}, {}

    def weight(f, c):
        lean = z.get((f, c), 0.0)
        if abs(lean) <= I.L1:
            return 0.0
        return -(lean - math.copysign(I.L1, lean)) / ((I.BETA + math.sqrt(n.get((f, c), 0.0))) / I.ALPHA + I.L2)

    for _ in range(I.EPOCHS):
        for i in np.random.default_rng(7).permutation(len(rows)):
            label, own, shares = rows[i]
            logits = [sum(s * I.SCALE * weight(f, c) for f, s in zip(own.tolist(), shares)) for c in range(3)]
            total = sum(math.exp(x - max(logits)) for x in logits)
            for c in range(3):
                error = math.exp(logits[c] - max(logits)) / total - (c == label)
                for f, s in zip(own.tolist(), shares):
                    g = s * I.SCALE * error
                    w, before = weight(f, c), n.get((f, c), 0.0)
                    z[f, c] = z.get((f, c), 0.0) + g - (math.sqrt(before + g * g) - math.sqrt(before)) / I.ALPHA * w
                    n[f, c] = before + g * g
    # The weights of one row are read before any is changed; no feature repeats in a row.
    assert temperature == 1.0
    want = {(f, c): weight(f, c) * I.SCALE for f in range(8) for c in range(3)}
    assert all(abs(got[f, c] - w) < 1e-9 for (f, c), w in want.items()) and np.count_nonzero(got) <= 24


def test_more_languages_than_learned(spark):
    """The languages with the most documents are learned; no number of others ends the query."""
    rows = [(i, f"text number {i}", f"x{i:04d}", "s", 1) for i in range(1_200)] + [
        (2_000 + i, "the river and the hill" if i % 2 else "die und der mit", "en" if i % 2 else "de", "s", 1) for i in range(200)
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    languages, weights, _ = I.fit(frame)
    assert len(languages) == I.MOST_LANGUAGES and {"en", "de"} <= set(languages) and languages == sorted(languages)
    got = I.identify_languages(frame, F.lit(True)).collect()
    assert len(got) == 1_400 and all(r.lang_pred in languages for r in got)
