"""A quality classifier by compression: two zstandard dictionaries, one built from blocks of good
texts and one from blocks of bad ones. A text is compressed whole, block by block, with both;
the size with the bad dictionary less the size with the good one, by byte of text, says which
kind it is closer to, and isotonic regression on labelled texts that no dictionary has seen
turns it into the chance of label 1.

Learning reads a bounded sample of the labelled rows, whatever their number: per label the
DOCUMENTS ids least by a hash, of whose texts the BLOCKS blocks least by a hash build the
dictionary, and CALIBRATION further ids to calibrate with (an id serves one purpose, by its
hash). These ids are what is broadcast; the documents are scanned once for them and not
shuffled. Only blocks and differences of sizes reach the driver. The dictionaries (DICTIONARY
bytes each) and the steps of the calibration go to the tasks, which score whole texts row by
row. Ids, languages and sources are never read for a score.

Edge cases: a null, empty or blank text has nothing to compress and is scored by the difference
0; labels that are null, or that contradict each other for one id, and labelled documents
without text are not learned from; rows that repeat are learned from as often as they stand. If
a label has too few blocks for zstandard to train a dictionary, the blocks themselves (or
nothing) are the dictionary; if calibration has no documents, every score is 0.5. Further
columns of the documents pass through, and those named like the results are replaced.
"""

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, functions as F, types as T

from postlake.llm.words import text_chunks
from postlake.session import stage

BLOCK = 512
#: Bounds of the sample: documents and blocks of each label, documents of the calibration.
DOCUMENTS = 5_000
BLOCKS = 6_000
CALIBRATION = 20_000
DICTIONARY = 65_536
LEVEL = 3
#: Out of so many labelled documents one calibrates and the others build dictionaries.
SHARES = 4
RESULTS = ["difference", "score"]


def blocks_of(text: bytes) -> list:
    return [text[at : at + BLOCK] for at in range(0, len(text), BLOCK)]


class Model:
    """Two dictionaries (bad, good) and the calibration: steps, and a slope that keeps the order
    of differences within a step."""

    SLOPE = 0.01

    def __init__(self, dictionaries: list):
        self.dictionaries, self._compressors = dictionaries, None
        self.calibrate(np.zeros(0), np.zeros(0))

    def __getstate__(self):
        return self.__dict__ | {"_compressors": None}

    def compressors(self) -> list:
        """Made once in each process that uses the model."""
        if self._compressors is None:
            self._compressors = []
            for data in self.dictionaries:
                how = dict(level=LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False)
                if data:
                    how["dict_data"] = zstandard.ZstdCompressionDict(data)
                    how["dict_data"].precompute_compress(level=LEVEL)
                self._compressors.append(zstandard.ZstdCompressor(**how))
        return self._compressors

    def difference(self, text: bytes | None) -> float:
        """How many bytes less each byte of the text takes with the good dictionary."""
        if not text or not text.strip():
            return 0.0
        bad, good = (sum(len(c.compress(block)) for block in blocks_of(text)) for c in self.compressors())
        return (bad - good) / len(text)

    def calibrate(self, differences: np.ndarray, good: np.ndarray) -> None:
        self.steps = isotonic_steps(differences, good)
        self.middle, self.spread = (differences.mean(), differences.std() or 1.0) if len(differences) else (0.0, 1.0)

    def score(self, differences: np.ndarray) -> np.ndarray:
        """By the step of a difference; between steps in proportion, beyond the last as at it."""
        order = 0.5 + np.arctan((differences - self.middle) / self.spread) / np.pi
        return (1 - self.SLOPE) * np.interp(differences, *self.steps) + self.SLOPE * order


def built_dictionary(blocks: list) -> bytes:
    """A trained dictionary, or the blocks end to end where there are too few to train one."""
    try:
        return zstandard.train_dictionary(DICTIONARY, blocks).as_bytes()
    except zstandard.ZstdError:
        return b"".join(blocks)[-DICTIONARY:]


def isotonic_steps(differences: np.ndarray, good: np.ndarray):
    """(differences, chances): rising steps by pooling adjacent violators, each from its least to
    its greatest difference. A step's chance is that of its documents and of one more with the
    overall chance."""
    pools: list = []  # least and greatest difference, sum of labels, number
    order = np.argsort(differences, kind="stable")
    for x, y in zip(differences[order].tolist(), good[order].tolist()):
        pools.append((x, x, y, 1))
        while len(pools) > 1 and (
            pools[-2][2] * pools[-1][3] >= pools[-1][2] * pools[-2][3] or pools[-2][1] == pools[-1][0]
        ):
            _, high, total, n = pools.pop()
            low, _, before, m = pools.pop()
            pools.append((low, high, before + total, m + n))
    if not pools:
        return (0.0,), (0.5,)
    chances = np.maximum.accumulate([(total + good.mean()) / (n + 1) for _, _, total, n in pools])
    return [x for low, high, _, _ in pools for x in (low, high)], np.repeat(chances, 2).tolist()


def _sampled_blocks(batches):
    """(doc_id, at, block, quality) of whole texts."""
    for batch in batches:
        ids, labels = batch.column(0), batch.column(2).to_pylist()
        for first, texts in text_chunks(batch, "text"):
            rows = [(i, at, block) for i, text in enumerate(texts) for at, block in enumerate(blocks_of(text))]
            places = [first + i for i, _, _ in rows]
            yield pa.RecordBatch.from_arrays(
                [
                    ids.take(pa.array(places, pa.int64())), pa.array([at for _, at, _ in rows], pa.int64()),
                    pa.array([block for _, _, block in rows], pa.binary()), pa.array([labels[i] for i in places], pa.int32()),
                ],
                names=["doc_id", "at", "block", "quality"],
            )


def _differences(model: Model):
    def run(batches):
        for batch in batches:
            labels = batch.column(1)
            for first, texts in text_chunks(batch, "text"):
                values = [model.difference(text) for text in texts]
                yield pa.RecordBatch.from_arrays([pa.array(values, pa.float64()), labels.slice(first, len(texts))], names=["difference", "quality"])

    return run


def learn(docs: DataFrame, labels: DataFrame, training: Column) -> Model:
    """A model from documents (doc_id, text) and labels (doc_id, quality 0 or 1) where
    `training`, a condition on doc_id, holds."""
    known = labels.where(training & F.col("quality").isin(0, 1)).groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(
        F.min("quality").cast("int").alias("quality"), F.max("quality").cast("int").alias("most")
    ).where("quality = most").select(
        "doc_id", "quality", (F.pmod(F.xxhash64("doc_id"), F.lit(SHARES)) == 0).alias("calibrates")
    )
    least = lambda frame, n: frame.orderBy(F.xxhash64("doc_id", F.lit("sample")), "doc_id").limit(n)
    builds = known.where("not calibrates")
    # At most 2 * DOCUMENTS + CALIBRATION ids, whatever the number of labels.
    chosen = stage(
        least(builds.where("quality = 0"), DOCUMENTS).union(least(builds.where("quality = 1"), DOCUMENTS)).union(
            least(known.where("calibrates"), CALIBRATION)
        ), "labelled-ids",
    )
    texts = docs.where(training & F.coalesce(F.length(F.trim("text")) > 0, F.lit(False))).select(
        F.col("doc_id").cast("bigint").alias("doc_id"), "text"
    )
    labelled = stage(texts.join(F.broadcast(chosen), "doc_id"), "labelled-texts")
    blocks = labelled.where("not calibrates").select("doc_id", "text", "quality").mapInArrow(
        _sampled_blocks, "doc_id bigint, at bigint, block binary, quality int"
    )
    order = [F.xxhash64("doc_id", "at"), "doc_id", "at", "block"]
    model = Model([
        built_dictionary([bytes(r.block) for r in blocks.where(F.col("quality") == q).orderBy(*order).limit(BLOCKS).select("block").collect()])
        for q in (0, 1)
    ])
    rows = labelled.where("calibrates").select("text", "quality").mapInArrow(
        _differences(model), "difference double, quality int"
    ).orderBy("difference", "quality").collect()
    model.calibrate(np.array([r.difference for r in rows]), np.array([r.quality for r in rows], float))
    return model


def _scored(model: Model):
    def run(batches):
        for batch in batches:
            rest = [i for i, name in enumerate(batch.schema.names) if name not in RESULTS]
            for first, texts in text_chunks(batch, "text"):
                part = batch.slice(first, len(texts))
                values = np.array([model.difference(text) for text in texts])
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(i) for i in rest), pa.array(values), pa.array(model.score(values))],
                    names=[*(batch.schema.names[i] for i in rest), *RESULTS],
                )

    return run


def score_quality(docs: DataFrame, model: Model) -> DataFrame:
    """Every row with the difference of compressed sizes by byte, and the chance of label 1."""
    rest = [field for field in docs.schema if field.name not in RESULTS]
    results = [T.StructField(name, T.DoubleType()) for name in RESULTS]
    return docs.mapInArrow(_scored(model), T.StructType([*rest, *results]))
