"""Byte-level BPE encoding and decoding with a local rank file.

Each match of the split pattern is merged separately, without special tokens.
The encoder is built once per Python worker from the rank file, whose path is
a parameter. A long text is first cut at safe boundaries: between a
non-space and a white-space character no match of the pattern can span and no
look-ahead sees across, so the pieces encode to the same ids as the whole.
Decoding joins the raw bytes of the ids.

Null text: encoded as the empty text (no ids). Empty tables give empty
results; repeated rows are each encoded; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

SAFE = regex.compile(r"(?<=\S)(?=\s)")
PIECE_CHARS = 1 << 16
_built: dict = {}


def encoder(rank_path: str, pattern: str):
    """(tiktoken encoding, bytes by id) of a rank file; kept per process."""
    key = (rank_path, pattern)
    if key not in _built:
        import tiktoken
        ranks = {}
        with open(rank_path, "rb") as f:
            for line in f:
                if line.strip():
                    token, rank = line.split()
                    ranks[base64.b64decode(token)] = int(rank)
        _built[key] = (tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}),
                       {v: k for k, v in ranks.items()})
    return _built[key]


def pieces(text: str, size: int = PIECE_CHARS):
    """Cut ``text`` at safe boundaries into pieces of about ``size`` characters;
    a run without such a boundary stays whole."""
    at = 0
    while len(text) - at > size:
        m = SAFE.search(text, at + size)
        if m is None:
            break
        yield text[at:m.start()]
        at = m.start()
    yield text[at:] if at else text


def encode(text: str, enc) -> np.ndarray:
    if len(text) <= PIECE_CHARS:
        return np.array(enc.encode_ordinary(text), dtype="<u4")
    return np.concatenate([np.array(enc.encode_ordinary(p), dtype="<u4") for p in pieces(text)])


def decode(ids: np.ndarray, table: dict) -> bytes:
    return b"".join(map(table.__getitem__, ids.tolist()))


def encode_documents(docs: DataFrame, rank_path: str, pattern: str) -> DataFrame:
    """doc_id, ids (array<int>), decoded (binary) of every row."""
    def run(batches):
        enc, table = encoder(rank_path, pattern)
        for b in batches:
            ids = [encode(t or "", enc) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([x.astype(np.int32) for x in ids], pa.list_(pa.int32())),
                 pa.array([decode(x, table) for x in ids], pa.binary())], names=["doc_id", "ids", "decoded"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, ids array<int>, decoded binary")


def digest_documents(docs: DataFrame, rank_path: str, pattern: str) -> DataFrame:
    """Encode, decode and digest every row in one pass: doc_id, n_tokens,
    ids_sha256, decoded_sha256, round_trip (decoded bytes equal the text's)."""
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, round_trip boolean"

    def run(batches):
        enc, table = encoder(rank_path, pattern)
        for b in batches:
            n, ids_sha, text_sha, same = [], [], [], []
            for value in b.column(1):
                text = value.as_py() or ""
                ids = encode(text, enc)
                back = decode(ids, table)
                n.append(len(ids))
                ids_sha.append(hashlib.sha256(ids.tobytes()).hexdigest())
                text_sha.append(hashlib.sha256(back).hexdigest())
                same.append(back == text.encode())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()),
                 pa.array(text_sha, pa.string()), pa.array(same, pa.bool_())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "round_trip"])

    return docs.select("doc_id", "text").mapInArrow(run, schema)
