r"""Byte-level BPE with the tiktoken library and a local rank file.

Texts are cut before a blank that follows a non-blank character. A match of the
pre-splitting pattern can begin with such a blank but never run over it, and its
only look-ahead inspects blanks to the right, so encoding the pieces one by one
gives exactly the ids of the whole text, in bounded memory.

Defined results: a null text counts as empty and gives no ids; empty tables give
empty results; rows are independent, so repeated rows repeat their result; columns
other than ``doc_id`` and ``text`` do not take part.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame

from faregrid.llm.ship import ship

PIECE_CHARS = 100_000
_CUT = re.compile(r"(?<=[^\s\x1c-\x1f\x85])(?= )")


@lru_cache(maxsize=4)
def encoding(ranks_path: str, pattern: str) -> tiktoken.Encoding:
    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def pieces(text: str, size: int = PIECE_CHARS) -> Iterator[str]:
    """Cut at the first safe place at or after each ``size`` characters."""
    start = 0
    while len(text) - start > size:
        cut = _CUT.search(text, start + size)
        if cut is None:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:]


def encode_text(enc: tiktoken.Encoding, text: str, size: int = PIECE_CHARS) -> list[int]:
    if len(text) <= size:
        return enc.encode_ordinary(text)
    return [i for piece in pieces(text, size) for i in enc.encode_ordinary(piece)]


def _digests(ranks_path: str, pattern: str, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(ranks_path, pattern)
        for batch in batches:
            counts, ids_sha, bytes_sha, packed, same = [], [], [], [], []
            for value in batch.column("text"):
                text = value.as_py() or ""
                ids = encode_text(enc, text)
                raw = np.asarray(ids, dtype="<u4").tobytes()
                back = enc.decode_bytes(ids)
                counts.append(len(ids))
                ids_sha.append(hashlib.sha256(raw).hexdigest())
                bytes_sha.append(hashlib.sha256(back).hexdigest())
                same.append(back == text.encode())
                if with_ids:
                    packed.append(raw)
            columns = {
                "doc_id": batch.column("doc_id"),
                "n_tokens": pa.array(counts, pa.int64()),
                "ids_sha256": pa.array(ids_sha, pa.string()),
                "decoded_sha256": pa.array(bytes_sha, pa.string()),
                "round_trip": pa.array(same, pa.bool_()),
            }
            if with_ids:
                columns["ids"] = pa.array(packed, pa.binary())
            yield pa.RecordBatch.from_pydict(columns)

    return run


def encode_decode(
    docs: DataFrame, ranks_path: str, pattern: str, with_ids: bool = False
) -> DataFrame:
    """Per document: ids (little-endian 32-bit, on request), their count and digests.

    Each row is encoded where it is read: no shuffle, and the ids are decoded back to
    raw bytes whose digest shows the round trip.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = (
        f"doc_id {id_type}, n_tokens bigint, ids_sha256 string, decoded_sha256 string,"
        " round_trip boolean" + (", ids binary" if with_ids else "")
    )
    ship(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(
        _digests(ranks_path, pattern, with_ids), schema
    )


def decode(rows: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """``doc_id`` and ``raw`` bytes from rows with ``doc_id`` and packed ``ids``."""
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(ranks_path, pattern)
        for batch in batches:
            raw = [
                enc.decode_bytes(np.frombuffer(v.as_py() or b"", dtype="<u4").tolist())
                for v in batch.column("ids")
            ]
            yield pa.RecordBatch.from_pydict(
                {"doc_id": batch.column("doc_id"), "raw": pa.array(raw, pa.binary())}
            )

    ship(rows.sparkSession)
    return rows.select("doc_id", "ids").mapInArrow(run, f"doc_id {id_type}, raw binary")
