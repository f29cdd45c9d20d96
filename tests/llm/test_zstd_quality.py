import zlib

import numpy as np
from pyspark.sql import functions as F
from samples import HARD, OTHER, PROSE

from postlake.llm import queries as Q, zstd_quality as Z

SF = "/root/testdata/sf0.1"


def test_held_out_documents(spark):
    """Ranking, decision and calibration on documents whose labels were not read."""
    rows = Q.op13_quality_classifier(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").where("held_out").toPandas()
    assert all(rows.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in rows.doc_id])
    good, score = rows.quality.to_numpy() == 1, rows.score.to_numpy()
    ranks = rows.score.rank().to_numpy()
    n, m = good.sum(), (~good).sum()
    assert (ranks[good].sum() - n * (n + 1) / 2) / (n * m) > 0.99
    assert ((score >= 0.3) == (rows.predicted == 1)).all() and (rows.predicted == good).mean() > 0.97
    assert ((score - good) ** 2).mean() < 0.03 and score.min() >= 0 and score.max() <= 1
    assert abs(score.mean() - good.mean()) < 0.03


def test_scores_equal_plain_python(spark):
    """The model's sizes and steps, redone text by text; held-out labels change nothing."""
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    training = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0
    model = Z.learn(docs, labels, training)
    turned = labels.withColumn("quality", F.when(training, F.col("quality")).otherwise(1 - F.col("quality")))
    other = Z.learn(docs.withColumn("quality", F.lit("x")), turned, training)
    assert model.dictionaries == other.dictionaries and model.steps == other.steps
    got = {r.doc_id: (r.difference, r.score) for r in Z.score_quality(docs.drop("lang"), model).collect()}
    import zstandard

    packers = [
        zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(d), write_content_size=False, write_dict_id=False, write_checksum=False)
        for d in model.dictionaries
    ]
    for r in docs.collect():
        text = r.text.encode()
        bad, good = (sum(len(p.compress(text[i : i + 512])) for i in range(0, len(text), 512)) for p in packers)
        assert got[r.doc_id][0] == ((bad - good) / len(text) if text.strip() else 0)
        x, (xs, ys) = got[r.doc_id][0], model.steps
        place = int(np.searchsorted(xs, x))
        step = ys[0] if place == 0 else ys[-1] if place == len(xs) else ys[place] if xs[place] == x else (
            ys[place - 1] + (ys[place] - ys[place - 1]) * (x - xs[place - 1]) / (xs[place] - xs[place - 1])
        )
        assert abs(got[r.doc_id][1] - step) < 0.011


def test_isotonic_steps():
    x, y = np.array([1.0, 2, 3, 3, 4, 5]), np.array([0.0, 1, 0, 1, 1, 1])
    steps, chances = Z.isotonic_steps(x, y)
    assert list(steps) == [1, 1, 2, 3, 4, 5] and (np.diff(chances) >= 0).all()
    m = y.mean()
    assert np.allclose(chances[::2], [m / 2, (2 + m) / 4, (2 + m) / 3])


def test_hard_rows(spark, hard, empty):
    frame = hard.withColumn("score", F.lit("old")).withColumn("quality", F.lit(True))
    labels = spark.createDataFrame(
        [(1, 1, 0), (2, 0, 0), (2, 1, 0), (3, None, 0), (None, 1, 0), (99, 1, 1), (4, 0, 1), (4, 0, 1), (5, 1, 0), (6, 0, 0), (12, 1, 0)],
        "doc_id long, quality int, toxic int",
    )
    for known in (labels, labels.where("quality = 1"), labels.where("false")):
        model = Z.learn(frame, known, F.lit(True))
        rows = Z.score_quality(frame, model).collect()
        assert len(rows) == len(HARD) and all(0 <= r.score <= 1 for r in rows)
        assert all(r.difference == 0 for r in rows if not (r.text or "").strip())
        assert {r.score for r in rows if r.text == PROSE and r.doc_id == 1} == {next(r.score for r in rows if r.doc_id == 2)}
    assert all(r.score == 0.99 * 0.5 + 0.01 * (0.5 + np.arctan(r.difference) / np.pi) for r in rows)
    assert Z.score_quality(empty, model).count() == 0 and Z.learn(empty, labels, F.lit(True)).dictionaries == [b"", b""]
    assert OTHER in {r.text for r in rows}
