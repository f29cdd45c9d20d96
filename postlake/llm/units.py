"""Repeated passages by hashing lines or paragraphs, and the pieces of text inside them.

Units of two kinds are normalised (A-Z lower-cased, words joined by single spaces), grouped by
digest over all documents, and of each digest the first occurrence by (doc_id, position) stays:

- Lines or paragraphs. A later one goes if it has `min_words` words, or if it lies in a run of
  repeated ones of `run_words` words together, so that a passage of many short lines goes whole
  and a short phrase alone does not.
- Stretches of two neighbouring pieces, whatever the lines. A piece begins at a word whose hash
  is the least within REACH words on either side, so the same words are cut alike wherever they
  stand, also in a passage that begins and ends inside lines. Where later stretches overlap or
  touch and cover `passage_words` words together, they go. A piece has 2 * REACH + 1 words on
  average, and a repeated passage is covered but for some words at either end (on average twice
  REACH at each), so a passage of over 50 words is found at the default of 25.

What goes keeps its offsets (in characters) in the original text. A line of which all words go
is taken out with its separator. Of other lines a stretch is cut from its first word to the
next word that stays, or, where none follows in the line, from the end of the last word that
stays to the end of the line.

Layout: one aggregation by digest with partial sums finds the digests that occur twice, and
one join with them finds the occurrences that go, so a line in a third of all documents is an
ordinary skewed join key. Only places travel back to the texts. Digests have 128 bits for
lines and 64 for stretches, of which a chance match alone removes nothing.

Edge cases: a null text stays null and an empty one empty; units without a word are never
removed; a null doc_id ranks last; rows that repeat both id and text are one document and are
returned each with the same result; rows that repeat only the id are told apart by 32 bits of
a hash of their text. Further columns pass through, and those named like the results are replaced.
"""

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from postlake.llm.columns import unused
from postlake.llm.words import LOWER, STEP, U, mix, text_chunks
from postlake.session import stage

SEPARATORS = {"line": "\n", "paragraph": "\n\n"}
MIN_WORDS = 10
RUN_WORDS = 50
PASSAGE_WORDS = 25
REACH = 4
UNITS = "doc_id bigint, text_key int, at int, n_words int, digest binary"
#: Bytes of the digests, by which the two kinds of unit are told apart.
LINE_BYTES = 16
RESULTS = [T.StructField(c, T.LongType()) for c in ("n_units", "n_removed", "n_removed_words")] + [
    T.StructField("removed_spans", T.StringType())
]
WORD = re.compile("[^ \t-\r]+")
LAST_ID = (1 << 63) - 1
#: Bytes of text worked on at a time by a task, though always whole texts.
AT_A_TIME = 1_000_000


class WordHashes(dict):
    """The first 64 bits of the MD5 of words, remembered."""

    MOST = 200_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.MOST:
            self.clear()
        self[word] = found = int.from_bytes(hashlib.md5(word, usedforsecurity=False).digest()[:8], "big")
        return found


def piece_starts(hashes: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Marks of the words at which pieces begin: the first word of each text, and each word
    whose hash is less than those of the REACH words before it and no more than those of the
    REACH words behind it, in its text."""
    # Texts are set apart by hashes that are greater than any other.
    sizes = np.diff(begins)
    padded = np.full(len(hashes) + REACH * (len(sizes) + 1), np.iinfo(U).max, U)
    places = np.arange(len(hashes)) + REACH * (1 + np.repeat(np.arange(len(sizes)), sizes))
    padded[places] = hashes
    least = np.ones(len(hashes), bool)
    for i in range(1, REACH + 1):
        least &= (hashes < padded[places - i]) & (hashes <= padded[places + i])
    least[begins[:-1][sizes > 0]] = True
    return least


def stretches(hashes: np.ndarray, begins: np.ndarray):
    """(text, first word in it, number of words, digest) of each two neighbouring pieces."""
    starts = np.flatnonzero(piece_starts(hashes, begins))
    if len(starts) < 2:
        return np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(0, U)
    sizes = np.diff(starts, append=len(hashes))
    place = np.arange(len(hashes)) - np.repeat(starts, sizes)
    powers = np.full(int(sizes.max()), STEP)
    powers[0] = 1
    powers = np.multiply.accumulate(powers)
    pieces = mix(np.add.reduceat(mix(hashes) * powers[place], starts) + sizes.astype(U))
    text = np.searchsorted(begins, starts, side="right") - 1
    both = np.flatnonzero(text[1:] == text[:-1])
    digests = mix(pieces[both] * STEP + pieces[both + 1])
    at = starts[both] - begins[text[both]]
    return text[both], at.astype(np.int32), (sizes[both] + sizes[both + 1]).astype(np.int32), digests


def _units(separator: bytes):
    types = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary()]
    names = [field.split()[0] for field in UNITS.split(", ")]

    def run(batches):
        known = WordHashes()
        for batch in batches:
            for first, texts in text_chunks(batch, "text", AT_A_TIME):
                owners, ats, sizes, digests, hashes, begins = [], [], [], [], [], [0]
                for i, text in enumerate(texts):
                    at = 0
                    for unit in (text or b"").translate(LOWER).split(separator):
                        words = unit.split()
                        if words:
                            owners.append(i)
                            ats.append(at)
                            sizes.append(len(words))
                            digests.append(hashlib.blake2b(b" ".join(words), digest_size=LINE_BYTES).digest())
                            hashes.append(np.fromiter(map(known.__getitem__, words), U, len(words)))
                            at += len(words)
                    begins.append(begins[-1] + at)
                if not owners:
                    continue
                owner, at, size, digest = stretches(np.concatenate(hashes), np.array(begins))
                # Fixed-width digests as one buffer with offsets.
                raw = digest.astype("<u8").tobytes()
                packed = pa.BinaryArray.from_buffers(
                    pa.binary(), len(digest), [None, pa.py_buffer(np.arange(0, 8 * len(digest) + 1, 8, dtype=np.int32)), pa.py_buffer(raw)]
                )
                part = batch.slice(first, len(texts))
                for own, *columns in (
                    (pa.array(owners, pa.int64()), pa.array(ats, types[2]), pa.array(sizes, types[3]), pa.array(digests, types[4])),
                    (pa.array(owner, pa.int64()), pa.array(at, types[2]), pa.array(size, types[3]), packed),
                ):
                    if len(own):
                        yield pa.RecordBatch.from_arrays([part.column(0).take(own), part.column(1).take(own), *columns], names=names)

    return run


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint"), F.hash("text").alias("text_key"), "text")


def repeated_spans(
    docs: DataFrame, unit: str = "line", min_words: int = MIN_WORDS, run_words: int = RUN_WORDS, passage_words: int = PASSAGE_WORDS
) -> DataFrame:
    """(doc_id, text_key, start, end): the words that go, as spans that may overlap."""
    units = stage(_keyed(docs).mapInArrow(_units(SEPARATORS[unit].encode()), UNITS), "units")
    rank = F.struct(F.coalesce("doc_id", F.lit(LAST_ID)).alias("id"), "text_key", "at")
    firsts = units.groupBy("digest").agg(F.min(rank).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    later = units.join(firsts, "digest").where(rank > F.col("first")).select(
        "doc_id", "text_key", (F.length("digest") == LINE_BYTES).alias("line"),
        F.col("at").alias("start"), (F.col("at") + F.col("n_words")).alias("end"),
    )
    # Spans that overlap or touch are a run.
    own = Window.partitionBy("doc_id", "text_key", "line")
    before = F.max("end").over(own.orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1))
    marked = later.withColumn("new", F.coalesce(F.col("start") > before, F.lit(True)).cast("int"))
    runs = marked.withColumn("run", F.sum("new").over(own.orderBy("start", "end").rowsBetween(Window.unboundedPreceding, 0)))
    run = Window.partitionBy("doc_id", "text_key", "line", "run")
    covered = F.max("end").over(run) - F.min("start").over(run)
    weighed = runs.withColumn("covered", covered)
    long_line = F.col("line") & ((F.col("end") - F.col("start") >= min_words) | (F.col("covered") >= run_words))
    return weighed.where(long_line | (~F.col("line") & (F.col("covered") >= passage_words))).select("doc_id", "text_key", "start", "end")


def cut_text(text: str, gone: list, separator: str):
    """(text without the words of the spans, offsets of what was cut)."""
    lines, spans, at, word = [], [], 0, 0
    marks = np.zeros(max((end for _, end in gone), default=0) + 1, np.int64)
    for start, end in gone:
        marks[start] += 1
        marks[end] -= 1
    dropped = np.cumsum(marks) > 0
    for line in text.split(separator):
        places = [m.span() for m in WORD.finditer(line)]
        going = dropped[word : word + len(places)].tolist()
        going += [False] * (len(places) - len(going))
        word += len(places)
        if not any(going):
            lines.append(line)
        elif all(going):
            spans.append((at, at + len(line)))
        else:
            kept, left, last = [], 0, max(i for i, goes in enumerate(going) if not goes)
            i = 0
            while i < len(going):
                if not going[i]:
                    i += 1
                    continue
                end = next((j for j in range(i, len(going)) if not going[j]), len(going))
                cut = (places[i][0], places[end][0]) if i < last else (places[last][1], len(line))
                kept.append(line[left : cut[0]])
                spans.append((at + cut[0], at + cut[1]))
                left, i = cut[1], end
            lines.append("".join(kept) + line[left:])
        at += len(line) + len(separator)
    return separator.join(lines), spans, int(dropped.sum())


def _cut(separator: str, names: list, spans_column: str):
    def run(batches):
        for batch in batches:
            gone = batch.column(batch.schema.get_field_index(spans_column))
            for first, texts in text_chunks(batch, "text", AT_A_TIME):
                part = batch.slice(first, len(texts))
                out, figures = [], []
                for text, spans in zip(texts, gone.slice(first, len(texts)).to_pylist()):
                    text = None if text is None else text.decode()
                    n_units = sum(bool(line.strip(" \t\n\x0b\f\r")) for line in (text or "").split(separator))
                    cut, removed, n_words = cut_text(text, [(s["start"], s["end"]) for s in spans], separator) if spans else (text, [], 0)
                    out.append(cut)
                    figures.append((n_units, len(removed), n_words, ",".join(f"{a}-{b}" for a, b in removed)))
                results = [pa.array(column, pa.int64()) for column in list(zip(*figures))[:3]] + [pa.array([f[3] for f in figures], pa.string())]
                kept = [pa.array(out, pa.string()) if c == "text" else part.column(part.schema.get_field_index(c)) for c in names]
                yield pa.RecordBatch.from_arrays([*kept, *results], names=[*names, *(f.name for f in RESULTS)])

    return run


def substring_dedup(
    docs: DataFrame, unit: str = "line", min_words: int = MIN_WORDS, run_words: int = RUN_WORDS, passage_words: int = PASSAGE_WORDS
) -> DataFrame:
    """Every row with `text` cut, the number of units (lines or paragraphs with a word), of
    spans and of words removed, and `removed_spans` as start-end pairs in the original text, in
    order."""
    kept = docs.drop(*[f.name for f in RESULTS])
    gone, key, own_id, own_key = unused(kept.columns, "gone", "key", "id", "text_key")
    spans = repeated_spans(docs, unit, min_words, run_words, passage_words).groupBy(
        F.col("doc_id").alias(own_id), F.col("text_key").alias(own_key)
    ).agg(F.collect_set(F.struct("start", "end")).alias(gone))
    joined = kept.withColumn(key, F.hash("text")).join(
        spans, (F.col(key) == F.col(own_key)) & F.col("doc_id").cast("bigint").eqNullSafe(F.col(own_id)), "left"
    )
    fields = list(kept.schema)
    return joined.select(*[F.col(f"`{f.name}`") for f in fields], gone).mapInArrow(
        _cut(SEPARATORS[unit], [f.name for f in fields], gone), T.StructType([*fields, *RESULTS])
    )
