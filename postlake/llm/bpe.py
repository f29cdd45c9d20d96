"""Byte-level BPE through a sentencepiece model that is written from the vocabulary.

A rank file lists byte strings by merge rank. Each byte becomes one printable character (the
usual byte-level mapping), so every entry is a sentencepiece piece, scored by its negative
rank; sentencepiece merges the pair with the best score first, leftmost first, which is the
order of the ranks. Normalisation is the identity and no white space is added or escaped.

Texts are cut into pre-tokens by a pattern; a pre-token that is an entry itself is that entry
(no merges needed), others are encoded by the model. Ids are ranks. Decoding looks the bytes
of every id up again. The vocabulary is the only thing tasks carry; pre-tokens seen before
are kept in a table of bounded size.

Edge cases: a null text is encoded as an empty one: no ids, and nothing decoded. Any text
decodes to its own UTF-8 bytes. Ids, ties and repeated rows do not matter: rows are taken one
by one, every column of the input passes through, and columns named like the results are
replaced. An empty table gives an empty result. A vocabulary without all 256 bytes is refused.
"""

import base64
import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from postlake.llm.words import text_chunks

#: Pre-tokens a task remembers.
REMEMBERED = 300_000


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def byte_characters() -> dict[int, str]:
    """A printable character for each byte: its own if it has one, else one from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(0x100 + i) for i, b in enumerate(rest)}


def as_piece(token: bytes, characters: dict[int, str]) -> str:
    return token.decode("latin-1").translate(characters)  # one character per byte


def serialise_model(ranks: dict[bytes, int]) -> bytes:
    """A sentencepiece BPE model; piece i + 1 is the entry with the i-th lowest rank."""
    from sentencepiece import sentencepiece_model_pb2 as proto

    characters = byte_characters()
    if missing := [b for b in range(256) if bytes([b]) not in ranks]:
        raise ValueError(f"the vocabulary lacks {len(missing)} single bytes")
    model = proto.ModelProto()
    model.trainer_spec.model_type = proto.TrainerSpec.BPE
    model.trainer_spec.vocab_size = len(ranks) + 1
    model.trainer_spec.unk_id, model.trainer_spec.bos_id = 0, -1
    model.trainer_spec.eos_id, model.trainer_spec.pad_id = -1, -1
    model.normalizer_spec.name = "identity"
    model.normalizer_spec.add_dummy_prefix = False
    model.normalizer_spec.remove_extra_whitespaces = False
    model.normalizer_spec.escape_whitespaces = False
    model.pieces.add(piece="<unk>", score=0, type=proto.ModelProto.SentencePiece.UNKNOWN)
    for token, rank in sorted(ranks.items(), key=lambda item: item[1]):
        model.pieces.add(piece=as_piece(token, characters), score=-rank)
    return model.SerializeToString()


class ByteBpe:
    """Encodes and decodes inside a task."""

    def __init__(self, model: bytes, tokens: list[bytes], ranks: list[int], pattern: str):
        import regex
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.find = regex.compile(pattern).findall
        self.characters = byte_characters()
        self.ranks = np.array(ranks, np.uint32)
        self.entries = {token: rank for token, rank in zip(tokens, ranks)}
        self.bytes_of = np.full(int(self.ranks.max()) + 1, None, object)
        self.bytes_of[self.ranks] = tokens
        self.seen: dict[str, bytes] = {}

    def _learn(self, words: list[str]) -> None:
        new = [word for word in set(words) if word not in self.seen]
        merged = []
        for word in new:
            rank = self.entries.get(word.encode())
            if rank is None:
                merged.append(word)
            else:
                self.seen[word] = rank.to_bytes(4, "little")
        if not merged:
            return
        found = self.model.encode([as_piece(word.encode(), self.characters) for word in merged], num_threads=1)
        places = np.fromiter(itertools.chain.from_iterable(found), np.int64)
        ids = self.ranks[places - 1].astype("<u4").tobytes()
        ends = np.cumsum([4 * len(x) for x in found]).tolist()
        self.seen.update(zip(merged, (ids[i:j] for i, j in zip([0, *ends], ends))))

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit integers."""
        words = [self.find(text) for text in texts]
        if len(self.seen) > REMEMBERED:
            self.seen.clear()
        self._learn(list(itertools.chain.from_iterable(words)))
        return [b"".join(map(self.seen.__getitem__, own)) for own in words]

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(self.bytes_of[np.frombuffer(ids, "<u4")].tolist())


def vocabulary(path: str, pattern: str) -> tuple:
    """What `ByteBpe` is made of, read on the driver."""
    ranks = read_ranks(path)
    ordered = sorted(ranks.items(), key=lambda item: item[1])
    return serialise_model(ranks), [token for token, _ in ordered], [rank for _, rank in ordered], pattern


def _encode(parts: tuple, decode: bool):
    def run(batches):
        bpe = ByteBpe(*parts)
        for batch in batches:
            for first, texts in text_chunks(batch, "text"):
                ids = bpe.encode_all([(text or b"").decode("utf-8", "replace") for text in texts])
                part = batch.slice(first, len(texts))
                columns = [*part.columns, pa.array(ids, pa.binary()), pa.array([len(x) // 4 for x in ids], pa.int64())]
                names = [*part.schema.names, "ids", "n_tokens"]
                if decode:
                    columns.append(pa.array([bpe.decode(x) for x in ids], pa.binary()))
                    names.append("decoded")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def byte_bpe(docs: DataFrame, path: str, pattern: str, decode: bool = True) -> DataFrame:
    """The input with `ids` (binary, little-endian unsigned 32-bit), `n_tokens` and, if asked
    for, `decoded` (the bytes that the ids stand for)."""
    kept = docs.drop("ids", "n_tokens", "decoded")
    schema = T.StructType([*kept.schema.fields, T.StructField("ids", T.BinaryType()), T.StructField("n_tokens", T.LongType())])
    if decode:
        schema = schema.add("decoded", T.BinaryType())
    return kept.mapInArrow(_encode(vocabulary(path, pattern), decode), schema)


def byte_bpe_decode(tokens: DataFrame, path: str, pattern: str) -> DataFrame:
    """The input with `decoded` from its column `ids`."""
    kept = tokens.drop("decoded")
    parts = vocabulary(path, pattern)

    def run(batches):
        bpe = ByteBpe(*parts)
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index("ids")).to_pylist()
            decoded = pa.array([bpe.decode(x or b"") for x in ids], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, decoded], names=[*batch.schema.names, "decoded"])

    return kept.mapInArrow(run, T.StructType([*kept.schema.fields, T.StructField("decoded", T.BinaryType())]))


def digests(encoded: DataFrame) -> DataFrame:
    """Ids and decoded bytes as SHA-256 digests in hex."""
    return encoded.withColumns({
        "ids_sha256": F.sha2("ids", 256), "decoded_sha256": F.sha2("decoded", 256),
    }).drop("ids", "decoded")
