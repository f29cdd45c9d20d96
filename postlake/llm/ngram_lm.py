"""Log-probabilities of texts under a bigram model kept in Elias-Fano tries.

The model is learned from all training documents and scores every document. A text is its
lower-cased words and one end, which is also the context of the first word.

    unigram:  p1(w) = (c(w) + 1) / (N + V + 1)
    bigram:   p2(w | v) = (c(v w) + MU * p1(w)) / (c(v) + MU)

with counts c over training tokens, N of them, V distinct (Dirichlet smoothing, a proper
distribution over the known words and one unknown). p1 and c(v w) / (c(v) + MU) are stored as
16-bit steps of a logarithm, 4,096 to a factor of ten.

Layout: no table of the model is sent to every task, as it grows with the corpus. Documents
are packed into blocks of tokens. Blocks send their distinct words with counts to shards by
hash; a shard numbers its words and answers with numbers and counts. Blocks then send their
distinct pairs of known words to shards by context. A shard builds its part of the trie from
all training pairs, in memory-mapped files of its own task, answers every block's pairs from
it, and drops the files. A context with very many tokens is spread over several shards by its
successors, which needs no totals as c(v) is known by then. Repeated words and pairs of a
block are one entry, so hot ones are added up before they travel.

Edge cases: a null or empty text is its end alone; a null doc_id is training and is returned
as null; rows that repeat an id are documents of their own; without training documents every
token is unknown and has p1 = 1. Further columns are ignored. An empty table gives an empty
result.
"""

import tempfile

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from postlake.llm.eliasfano import Trie
from postlake.llm.words import U, mix, text_chunks, word_hashes
from postlake.session import drop_stage, stage

#: Weight of the unigram model, in tokens.
MU = 100.0
#: Steps of a stored logarithm per factor of ten, and the code of an n-gram not seen.
STEPS = 4_096
ABSENT = 65_535
#: Tokens of a block, distinct entries of a shard, and training tokens of a context per shard.
BLOCK_TOKENS = 1_500_000
SHARD_ENTRIES = 1_000_000
CONTEXT_TOKENS = 500_000
#: Stands for the end of a text; no word is hashed to it but by chance.
END = mix(np.array([2**63 + 11], U))[0]

#: Ids as texts: a list of numbers with a null in it reaches pandas in floating point.
BLOCKS = "block bigint, doc_ids array<string>, trained array<boolean>, lengths array<bigint>, words binary, tokens binary"


def pack(numbers: np.ndarray) -> bytes:
    """Whole numbers of 32 or 64 bits, byte planes apart, compressed."""
    import zstandard

    width = 8 if len(numbers) and int(numbers.max()) >= 2**32 else 4
    planes = np.ascontiguousarray(numbers.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T)
    return bytes([width]) + zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(data: bytes) -> np.ndarray:
    import zstandard

    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data[1:]), np.uint8)
    return np.ascontiguousarray(planes.reshape(data[0], -1).T).view(f"<u{data[0]}").ravel().astype(np.int64)


def pack_rising(numbers: np.ndarray) -> bytes:
    return pack(np.diff(numbers, prepend=0))


def unpack_rising(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data))


def _block_row(block: int, ids: list, trained: list, hashes: list) -> pa.RecordBatch:
    words, tokens = np.unique(np.concatenate(hashes), return_inverse=True)
    return pa.RecordBatch.from_pydict({
        "block": pa.array([block], pa.int64()),
        "doc_ids": pa.array([ids], pa.list_(pa.string())),
        "trained": pa.array([trained], pa.list_(pa.bool_())),
        "lengths": pa.array([[len(h) for h in hashes]], pa.list_(pa.int64())),
        "words": pa.array([words.tobytes()], pa.binary()),
        "tokens": pa.array([pack(tokens)], pa.binary()),
    })


def _blocks(batches):
    block, held, size = TaskContext.get().partitionId() << 32, ([], [], []), 0
    for batch in batches:
        ids, trained = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for first, texts in text_chunks(batch, "text"):
            hashes, begins = word_hashes(texts)
            for i in range(len(texts)):
                held[0].append(None if ids[first + i] is None else str(ids[first + i]))
                held[1].append(trained[first + i])
                held[2].append(np.append(hashes[begins[i] : begins[i + 1]], END))
                size += len(held[2][-1])
                if size >= BLOCK_TOKENS:
                    yield _block_row(block, *held)
                    block, held, size = block + 1, ([], [], []), 0
    if size:
        yield _block_row(block, *held)


def _shards(entries: int) -> int:
    return 1 << max(3, (entries // SHARD_ENTRIES).bit_length())


def _token_weights(row) -> np.ndarray:
    """1 for tokens of training documents, else 0."""
    return np.repeat(np.asarray(row["trained"], np.int64), row["lengths"])


def _cuts(shard: np.ndarray, shards: int):
    """(shard, entries in their order) of each shard that has some."""
    order = np.argsort(shard, kind="stable")
    ends = np.searchsorted(shard[order], np.arange(shards + 1))
    for i in np.flatnonzero(np.diff(ends)):
        yield int(i), order[ends[i] : ends[i + 1]]


def _ask_words(shards: int):
    shift = U(64 - shards.bit_length() + 1)

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                words = np.frombuffer(row["words"], U)
                counts = np.bincount(unpack(row["tokens"]), weights=_token_weights(row), minlength=len(words)).astype(np.int64)
                for shard, own in _cuts((words >> shift).astype(np.int64), shards):
                    yield pa.RecordBatch.from_pydict({
                        "shard": pa.array([shard], pa.int64()), "block": pa.array([row["block"]], pa.int64()),
                        "words": [words[own].tobytes()], "counts": [pack(counts[own])],
                    })

    return run


def _number_words(asked: pd.DataFrame) -> pd.DataFrame:
    """Each word's number among the trained words of the shard, and its count."""
    words = [np.frombuffer(x, U) for x in asked["words"]]
    known, places = np.unique(np.concatenate(words), return_inverse=True)
    counts = np.bincount(places, weights=np.concatenate([unpack(x) for x in asked["counts"]]), minlength=len(known)).astype(np.int64)
    numbers = np.cumsum(counts > 0) - 1
    cuts = np.cumsum([len(x) for x in words])[:-1]
    # The same figures stand in each row of the shard; they are read once per shard.
    return pd.DataFrame({
        "block": asked["block"], "shard": asked["shard"],
        # A word that was never trained has the number of the one before it, and count 0.
        "numbers": [pack_rising(x) for x in np.split(np.maximum(numbers, 0)[places], cuts)],
        "counts": [pack(x) for x in np.split(counts[places], cuts)],
        "n_words": int((counts > 0).sum()), "n_tokens": int(counts.sum()),
    })


def _numbered(firsts: dict):
    """Blocks with the number (a word's rank in hash order) and count of each of their words."""

    def run(blocks: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        answers = answers.sort_values("shard")
        numbers, counts, none = [], [], np.zeros(0, np.int64)
        for block in blocks["block"]:
            own = answers[answers["block"] == block]
            numbers.append(pack_rising(np.concatenate([none, *(
                unpack_rising(x) + firsts[s] for x, s in zip(own["numbers"], own["shard"])
            )])))
            counts.append(pack(np.concatenate([none, *map(unpack, own["counts"])])))
        return blocks.assign(numbers=numbers, counts=counts)

    return run


def _pairs(row) -> tuple:
    """Of a block: (place of each token's pair, contexts and words of the distinct pairs as
    places in the block's words, training count of each). Pairs come in order."""
    tokens = unpack(row["tokens"]).astype(U)
    weights = _token_weights(row)
    lengths = np.asarray(row["lengths"], np.int64)
    before = np.concatenate([tokens[:1], tokens[:-1]])
    # The last token of any text is its end, which is the context of the first.
    before[np.cumsum(lengths) - lengths] = tokens[-1]
    before <<= U(32)
    before |= tokens
    del tokens
    distinct, places = np.unique(before, return_inverse=True)
    counts = np.bincount(places, weights=weights, minlength=len(distinct)).astype(np.int64)
    return places, (distinct >> U(32)).astype(np.int64), (distinct & U(0xFFFFFFFF)).astype(np.int64), counts


def _pair_shards(contexts, words, numbers, counts, shards: int) -> np.ndarray:
    """The shard of each pair of known words, -1 for others."""
    parts = (counts[contexts] // CONTEXT_TOKENS + 1).astype(U)
    spread = mix(numbers[contexts].astype(U)) + mix(numbers[words].astype(U)) % parts
    shard = (spread % U(shards)).astype(np.int64)
    shard[(counts[contexts] == 0) | (counts[words] == 0)] = -1
    return shard


def _ask_pairs(shards: int):
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                numbers, counts = unpack_rising(row["numbers"]), unpack(row["counts"])
                _, contexts, words, seen = _pairs(row)
                for shard, own in _cuts(_pair_shards(contexts, words, numbers, counts, shards) , shards):
                    head = np.flatnonzero(np.diff(contexts[own], prepend=-1))
                    yield pa.RecordBatch.from_pydict({
                        "shard": pa.array([shard], pa.int64()), "block": pa.array([row["block"]], pa.int64()),
                        "contexts": [pack_rising(numbers[contexts[own][head]])],
                        "totals": [pack(counts[contexts[own][head]])],
                        "runs": [pack(np.diff(np.append(head, len(own))))],
                        "words": [pack(numbers[words[own]])],
                        "seen": [pack(seen[own])],
                    })

    return run


def _quantise(p: np.ndarray) -> np.ndarray:
    return np.minimum(np.rint(-np.log10(p) * STEPS), ABSENT - 1).astype(np.uint16)


def _answer_pairs(asked: pd.DataFrame) -> pd.DataFrame:
    """Builds the shard's trie in files, maps them, and answers every block from it."""
    words, runs = [unpack(x) for x in asked["words"]], [unpack(x) for x in asked["runs"]]
    contexts = [unpack_rising(x) for x in asked["contexts"]]
    known, ranks = np.unique(np.concatenate(contexts), return_inverse=True)
    totals = np.zeros(len(known), np.int64)
    totals[ranks] = np.concatenate([unpack(x) for x in asked["totals"]])
    ranks, all_words = np.repeat(ranks, np.concatenate(runs)), np.concatenate(words)
    order = np.lexsort((all_words, ranks))
    ranks, all_words = ranks[order], all_words[order]
    new = (np.diff(ranks, prepend=-1) != 0) | (np.diff(all_words, prepend=-1) != 0)
    place = np.empty(len(order), np.int64)
    place[order] = np.cumsum(new) - 1
    ranks, all_words = ranks[new], all_words[new]
    counts = np.bincount(place, weights=np.concatenate([unpack(x) for x in asked["seen"]])).astype(np.int64)
    trained = counts > 0
    own, sizes = np.unique(ranks[trained], return_counts=True)
    asked_for, asked_sizes = np.unique(ranks, return_counts=True)
    with tempfile.TemporaryDirectory() as folder:
        kept = _quantise(counts[trained] / (totals[ranks[trained]] + MU))
        Trie.save(folder, known[own], sizes, all_words[trained], kept)
        trie = Trie(folder)
        # Every distinct pair is looked for once, in order; blocks share the answers.
        found = trie.query(known[asked_for], asked_sizes, all_words, ABSENT)
        del trie
    codes = [x.tobytes() for x in np.split(found[place], np.cumsum([len(w) for w in words])[:-1])]
    return pd.DataFrame({"block": asked["block"], "shard": asked["shard"], "codes": codes})


def _score(n_tokens: int, n_words: int, shards: int):
    def run(blocks: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        out = []
        for row in blocks.to_dict("records"):
            numbers, counts = unpack_rising(row["numbers"]), unpack(row["counts"])
            places, contexts, words, _ = _pairs(row)
            codes = np.full(len(contexts), ABSENT, np.uint16)
            own = answers[answers["block"] == row["block"]].set_index("shard")["codes"]
            for shard, entries in _cuts(_pair_shards(contexts, words, numbers, counts, shards), shards):
                codes[entries] = np.frombuffer(own[shard], np.uint16)
            base = np.log10((counts + 1) / (n_tokens + n_words + 1))
            unigram = 10.0 ** (-_quantise(10.0**base).astype(np.float64) / STEPS)
            seen = np.where(codes == ABSENT, 0.0, 10.0 ** (-codes.astype(np.float64) / STEPS))
            bigram = np.log10(seen + MU * unigram[words] / (counts[contexts] + MU))
            tokens = unpack(row["tokens"])
            lengths = np.asarray(row["lengths"], np.int64)
            first = np.cumsum(lengths) - lengths
            out.append(pd.DataFrame({
                "doc_id": np.asarray(row["doc_ids"], object), "held_out": ~np.asarray(row["trained"], bool),
                "n_tokens": lengths, "n_known": np.add.reduceat((counts > 0)[tokens].astype(np.int64), first),
                "base_score": np.add.reduceat(base[tokens], first), "score": np.add.reduceat(bigram[places], first),
            }))
        return pd.concat(out) if out else pd.DataFrame(columns=["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"])

    return run


def score_texts(docs: DataFrame, trained) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row.

    `trained` is a boolean column: which documents the model learns from (null counts as
    true). Runs jobs when called.
    """
    rows = docs.select(F.col("doc_id").cast("bigint"), F.coalesce(trained, F.lit(True)).alias("trained"), "text")
    blocks = stage(rows.mapInArrow(_blocks, BLOCKS), "token-blocks")
    entries = blocks.agg(F.sum(F.octet_length("words")) / 8).first()[0] or 0
    asked = blocks.mapInArrow(_ask_words(_shards(int(entries))), "shard bigint, block bigint, words binary, counts binary")
    answers = stage(
        asked.groupBy("shard").applyInPandas(
            _number_words, "block bigint, shard bigint, numbers binary, counts binary, n_words bigint, n_tokens bigint"
        ),
        "word-numbers",
    )
    # One row per shard: a few numbers, of which only the running sum is needed.
    sizes = answers.groupBy("shard").agg(F.first("n_words"), F.first("n_tokens")).orderBy("shard").collect()
    firsts, n_words, n_tokens = {}, 0, 0
    for shard, more_words, more_tokens in sizes:
        firsts[shard] = n_words
        n_words, n_tokens = n_words + more_words, n_tokens + more_tokens
    numbered = stage(
        blocks.drop("words").groupBy("block").cogroup(answers.drop("n_words", "n_tokens").groupBy("block")).applyInPandas(
            _numbered(firsts),
            "block bigint, doc_ids array<string>, trained array<boolean>, lengths array<bigint>, tokens binary, "
            "numbers binary, counts binary",
        ),
        "numbered-blocks",
    )
    drop_stage(blocks, answers)
    pairs = numbered.agg(F.sum(F.aggregate("lengths", F.lit(0).cast("bigint"), lambda a, x: a + x))).first()[0] or 0
    shards = _shards(int(pairs))
    codes = numbered.mapInArrow(
        _ask_pairs(shards),
        "shard bigint, block bigint, contexts binary, totals binary, runs binary, words binary, seen binary",
    ).groupBy("shard").applyInPandas(_answer_pairs, "block bigint, shard bigint, codes binary")
    scored = numbered.groupBy("block").cogroup(codes.groupBy("block")).applyInPandas(
        _score(n_tokens, n_words, shards),
        "doc_id string, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double",
    )
    return scored.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), "held_out", "n_tokens", "n_known", F.lit(n_tokens).cast("bigint").alias("train_tokens"), "base_score", "score"
    )
