"""Language identification by sparse multinomial logistic regression on character n-grams.

A text is its letters in lower case, with one mark for each other character. Its n-grams of
one to three characters are hashed into `FEATURES` columns; a feature is the n-gram's share of
the text times its inverse document frequency. Weights are learned by follow-the-regularised-
leader with elastic-net penalties (McMahan et al., 2013), which leaves most of them zero. A
temperature, fitted on the fifth of the sample that the weights have not seen, makes scores
probabilities (Guo et al., 2017).

What covers what: document frequencies and the languages' counts come from all training
documents. Learned are the `MOST_LANGUAGES` languages with the most training documents (ties
by name), as weights are a table of features by languages; rarer ones are never predicted. The
weights from a sample of about `SAMPLE_ROWS` of them and never more than twice as many, drawn
evenly over languages, whole texts, read by the driver. Every document is scored on its whole text, in pieces.

Edge cases: a text that is null or has no letter is `und` with score 0; without any training
document every text is `und`. A null id passes through and, like a null language, is not
learned from if `trained` is null. Repeated rows are scored each. Texts of the same features
get the same result; ties go to the first language in order. Further columns are ignored. An
empty table gives an empty result.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from postlake.llm.words import text_chunks

BITS = 16
FEATURES = 1 << BITS
ORDERS = 3
#: Features are shares of a text; this brings them to the order of one.
SCALE = 30.0
SAMPLE_ROWS = 4_000
MOST_LANGUAGES = 256
#: Learning rate, its smoothing, and the penalties on absolute values and squares.
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.02
EPOCHS = 4
OTHER = 32
UNDETERMINED = "und"


def letter_table() -> np.ndarray:
    """Lower-case code of each letter of the basic plane, OTHER for the rest."""
    table = np.full(1 << 16, OTHER, np.uint32)
    for code in range(1 << 16):
        if chr(code).isalpha():
            lowered = chr(code).lower()
            table[code] = ord(lowered) if len(lowered) == 1 else code
    return table


def letters(texts: list, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(letters of all texts, begin of each with an end); a mark before and two behind each."""
    strings = [f" {(text or b'').decode('utf-8', 'replace')}  " for text in texts]
    codes = np.frombuffer("".join(strings).encode("utf-32-le"), np.uint32)
    out = table[np.minimum(codes, 0xFFFF)]
    for code in np.unique(codes[codes > 0xFFFF]):
        out[codes == code] = code if chr(code).isalpha() else OTHER
    return out, np.cumsum([0, *map(len, strings)])


def hashed(codes: np.ndarray) -> list[np.ndarray]:
    """For each order, the feature of the n-gram that begins at each character but the last two."""
    h = np.zeros(len(codes) - ORDERS + 1, np.uint32)
    out = []
    for order in range(ORDERS):
        h = (h ^ codes[order : len(h) + order]) * np.uint32(0x9E3779B1) + np.uint32(order)
        mixed = (h ^ (h >> np.uint32(15))) * np.uint32(0x85EBCA77)
        out.append(mixed >> np.uint32(32 - BITS))
    return out


def _spans(begins: np.ndarray):
    """Where each text's n-grams lie: all that begin before its last two marks."""
    return zip(begins[:-1], begins[1:] - ORDERS + 1)


def _document_frequencies(table: np.ndarray):
    def run(batches):
        total, seen = np.zeros(FEATURES, np.int64), np.zeros(FEATURES, bool)
        for batch in batches:
            for _, texts in text_chunks(batch, "text", 1_000_000):
                codes, begins = letters(texts, table)
                grams = hashed(codes)
                for begin, end in _spans(begins):
                    seen[:] = False
                    for own in grams:
                        seen[own[begin:end]] = True
                    total += seen
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"feature": pa.array(found, pa.int32()), "n": pa.array(total[found], pa.int64())})

    return run


def _sparse(table: np.ndarray):
    """Each text's features with their shares."""

    def run(batches):
        for batch in batches:
            for first, texts in text_chunks(batch, "text", 1_000_000):
                codes, begins = letters(texts, table)
                grams = hashed(codes)
                features, shares = [], []
                for begin, end in _spans(begins):
                    own, counts = np.unique(np.concatenate([g[begin:end] for g in grams]), return_counts=True)
                    features.append(own.astype(np.int32).tobytes())
                    shares.append((counts / counts.sum()).astype(np.float32).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(texts)), pa.array(features, pa.binary()), pa.array(shares, pa.binary())],
                    names=["lang", "features", "shares"],
                )

    return run


def _softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train(rows: list, idf: np.ndarray, n_classes: int, seed: int = 7) -> tuple[np.ndarray, float]:
    """(weights of features x classes with the idf in them, temperature) from rows of
    (class, features, shares)."""
    z, n = np.zeros((FEATURES, n_classes)), np.zeros((FEATURES, n_classes))

    def weights(own):
        leaning = z[own]
        return np.where(
            np.abs(leaning) > L1,
            -(leaning - np.sign(leaning) * L1) / ((BETA + np.sqrt(n[own])) / ALPHA + L2),
            0.0,
        )

    rows = [(label, own, share * idf[own] * SCALE) for label, own, share in rows]
    order = np.random.default_rng(seed).permutation(len(rows))
    checked, learned = order[::5] if len(order) > 50 else order[:0], np.delete(order, np.s_[::5]) if len(order) > 50 else order
    for _ in range(EPOCHS):
        for i in learned:
            label, own, values = rows[i]
            w = weights(own)
            p = _softmax(values @ w)
            p[label] -= 1.0
            g = values[:, None] * p
            sigma = (np.sqrt(n[own] + g * g) - np.sqrt(n[own])) / ALPHA
            z[own] += g - sigma * w
            n[own] += g * g
    final = weights(np.arange(FEATURES))
    if not len(checked):
        return final * idf[:, None] * SCALE, 1.0
    logits = np.array([rows[i][2] @ final[rows[i][1]] for i in checked])
    labels = np.array([rows[i][0] for i in checked])

    def loss(temperature):
        p = _softmax(logits / temperature)[np.arange(len(labels)), labels]
        return -np.log(np.maximum(p, 1e-12)).mean()

    low, high, golden = np.log(0.05), np.log(20.0), (np.sqrt(5) - 1) / 2
    for _ in range(40):
        a, b = high - golden * (high - low), low + golden * (high - low)
        low, high = (low, b) if loss(np.exp(a)) < loss(np.exp(b)) else (a, high)
    return final * idf[:, None] * SCALE, float(np.exp((low + high) / 2))


def fit(training: DataFrame) -> tuple[list[str], np.ndarray, float]:
    """(languages, weights, temperature) from rows with a text and a language."""
    table = letter_table()
    counts = training.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MOST_LANGUAGES).collect()
    counts.sort(key=lambda row: row["lang"])
    if not counts:
        return [], np.zeros((FEATURES, 0)), 1.0
    languages = [row["lang"] for row in counts]
    total = training.count()
    # FEATURES rows at most, whatever the corpus.
    frequencies = np.zeros(FEATURES)
    found = training.select("text").mapInArrow(_document_frequencies(table), "feature int, n bigint").groupBy("feature").agg(F.sum("n")).collect()
    for feature, n in found:
        frequencies[feature] = n
    idf = np.log((1.0 + total) / (1.0 + frequencies)) + 0.1
    each = SAMPLE_ROWS / len(languages)
    shares = training.sparkSession.createDataFrame(
        [(row["lang"], min(1.0, each / row["count"])) for row in counts], "lang string, part double"
    )
    place = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 20)) / float(1 << 20)
    sample = training.join(F.broadcast(shares), "lang").where(place < F.col("part")).select("lang", "text").limit(2 * SAMPLE_ROWS)
    rows = sample.mapInArrow(_sparse(table), "lang string, features binary, shares binary").collect()
    number = {name: i for i, name in enumerate(languages)}
    examples = sorted(
        (number[r["lang"]], bytes(r["features"]), bytes(r["shares"])) for r in rows
    )
    weights, temperature = train(
        [(label, np.frombuffer(f, np.int32), np.frombuffer(s, np.float32).astype(np.float64)) for label, f, s in examples],
        idf, len(languages),
    )
    return languages, weights, temperature


def _predict(languages: list[str], weights: np.ndarray, temperature: float, table: np.ndarray):
    columns = [np.ascontiguousarray(weights[:, i], np.float32) for i in range(len(languages))]

    def run(batches):
        for batch in batches:
            for first, texts in text_chunks(batch, "text", 1_000_000):
                codes, begins = letters(texts, table)
                grams = hashed(codes)
                spans = np.array(list(_spans(begins)))
                logits = np.zeros((len(texts), len(languages)))
                for i, column in enumerate(columns):
                    each = sum(column[own] for own in grams)
                    # Sums from each begin to the next place given, here each end; the last end
                    # lies behind all n-grams, so it needs a place.
                    logits[:, i] = np.add.reduceat(np.append(each, np.float32(0)), spans.ravel(), dtype=np.float64)[::2]
                lengths = (spans[:, 1] - spans[:, 0]) * ORDERS
                known = np.logical_or.reduceat(codes != OTHER, begins[:-1])
                p = _softmax(logits / lengths[:, None] / temperature) if languages else np.zeros((len(texts), 1))
                best = p.argmax(axis=1)
                named = known & bool(languages)
                part = batch.slice(first, len(texts))
                yield pa.RecordBatch.from_arrays(
                    [
                        *part.select([n for n in part.schema.names if n != "text"]).columns,
                        pa.array([languages[b] if ok else UNDETERMINED for b, ok in zip(best, named)]),
                        pa.array(np.where(named, p[np.arange(len(texts)), best], 0.0)),
                    ],
                    names=[*[n for n in part.schema.names if n != "text"], "lang_pred", "score"],
                )

    return run


def identify_languages(docs: DataFrame, trained) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row of documents (doc_id, text, lang).

    `trained` is a boolean column: which documents may be learned from. Runs jobs when called.
    """
    rows = docs.select(F.col("doc_id").cast("bigint"), "text", "lang", F.coalesce(trained, F.lit(False)).alias("trained"))
    model = fit(rows.where(F.col("trained") & F.col("lang").isNotNull() & F.col("text").isNotNull()))
    asked = rows.select("doc_id", (~F.col("trained")).alias("held_out"), "text")
    return asked.mapInArrow(_predict(*model, letter_table()), "doc_id bigint, held_out boolean, lang_pred string, score double")
