"""BPE encoding and decoding by forced-boundary splitting.

Two neighbouring bytes that no vocabulary token holds side by side can never
be merged, so a cut between them is certain. Each piece of the splitting
pattern is cut at all such pairs, the fragments are encoded independently
(and remembered, as fragments recur), and the ids are concatenated.
"""

from __future__ import annotations

import hashlib
import sys
from array import array

import pyarrow as pa
from pyspark.sql import DataFrame

from .bpe_vocab import Remembered, Vocabulary, loaded, vocabulary_bytes
from .common import prepare


class Codec:
    def __init__(self, vocabulary: Vocabulary) -> None:
        self.v = vocabulary
        #: Byte pairs that stand side by side in some token.
        self.joined = {pair for token in vocabulary.id_of for pair in zip(token, token[1:], strict=False)}
        self.pieces = Remembered(self.piece_ids)
        self.fragments = Remembered(self.fragment_ids)
        self.bytes_of = [vocabulary.bytes_of.get(i) for i in range(max(vocabulary.bytes_of) + 1)]

    def cut(self, piece: bytes) -> list[bytes]:
        """``piece`` cut at every pair that no token contains."""
        joined = self.joined
        at = [i for i, pair in enumerate(zip(piece, piece[1:], strict=False), 1) if pair not in joined]
        return [piece[i:j] for i, j in zip([0, *at], [*at, len(piece)], strict=True)] if at else [piece]

    def fragment_ids(self, fragment: bytes) -> bytes:
        return array("I", self.v.merge(fragment)).tobytes()

    def piece_ids(self, piece: str) -> bytes:
        return b"".join(map(self.fragments.__getitem__, self.cut(piece.encode())))

    def encode(self, text: str) -> array:
        """Ids of a whole text as unsigned 32-bit integers."""
        out = []
        for run, special in self.v.runs(text):
            out += map(self.pieces.__getitem__, self.v.words.findall(run))
            if special is not None:
                out.append(array("I", [special]).tobytes())
        return array("I", b"".join(out))

    def decode(self, ids) -> str:
        """The text of ids; bytes that are no UTF-8 become U+FFFD."""
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


def little_endian(ids: array) -> bytes:
    if sys.byteorder == "big":
        ids = array("I", ids)
        ids.byteswap()
    return ids.tobytes()


def encode_documents(docs: DataFrame, vocabulary: str, *, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """(id, token_ids, decoded) of every row, whole texts. A null or empty text
    gives no ids and an empty text; rows with a null or repeated id stay rows of
    their own; other columns are ignored. One narrow pass, no shuffle."""
    return _encoded(docs, vocabulary, id_col, text_col, digests=False)


def token_digests(docs: DataFrame, vocabulary: str, *, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """As :func:`encode_documents`, but only the digest of ids and of the decoded
    text, so that the result stays a few bytes a row."""
    return _encoded(docs, vocabulary, id_col, text_col, digests=True)


def _encoded(docs, vocabulary, id_col, text_col, digests):
    spark = docs.sparkSession
    prepare(spark)
    raw = spark.sparkContext.broadcast(vocabulary_bytes(vocabulary))
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))

    def run(batches):
        codec = loaded(Codec, raw.value)
        for batch in batches:
            n, a, b = [], [], []
            for text in batch.column(1).to_pylist():
                ids = codec.encode(text or "")
                decoded = codec.decode(ids)
                n.append(len(ids))
                a.append(hashlib.sha256(little_endian(ids)).hexdigest() if digests else ids.tolist())
                b.append(hashlib.sha256(decoded.encode()).hexdigest() if digests else decoded)
            kind = pa.string() if digests else pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(a, kind), pa.array(b, pa.string())],
                ["doc_id", "n_tokens", "a", "b"])

    kind, names = ("string", ("ids_sha256", "decoded_sha256")) if digests else ("array<int>", ("token_ids", "decoded"))
    out = rows.mapInArrow(run, f"doc_id long, n_tokens long, a {kind}, b string")
    return out.withColumnsRenamed({"a": names[0], "b": names[1]})


def decode_documents(rows: DataFrame, vocabulary: str, *, id_col: str = "doc_id",
                     ids_col: str = "token_ids") -> DataFrame:
    """(id, text) of rows with token ids. Null or empty ids give an empty text;
    an id outside the vocabulary is an error."""
    spark = rows.sparkSession
    prepare(spark)
    raw = spark.sparkContext.broadcast(vocabulary_bytes(vocabulary))
    rows = rows.select(rows[id_col].cast("long").alias("doc_id"), rows[ids_col].cast("array<int>").alias("ids"))

    def run(batches):
        codec = loaded(Codec, raw.value)
        for batch in batches:
            texts = [codec.decode(ids or ()) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return rows.mapInArrow(run, "doc_id long, text string")
