"""Byte-level BPE with the tiktoken library: encode whole texts, decode ids to raw bytes."""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A text longer than this is encoded in parts of about this many characters.
LONG = 65_536
#: Where one character is not white space and the next is, every match of the pattern ends.
SAFE = re.compile(r"\S(?=[ \t\r\n])")
#: Unicode's white space, which is what the library's patterns mean by ``\\s``, in a run that the pattern engine may overflow on.
_WHITE_RUN = re.compile(f"[ \t\n\x0b\x0c\r\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{{{LONG},}}")
_WHITE_RULE = r"\s+(?!\S)|\s+"


@lru_cache(maxsize=4)
def encoding(rank_path: str, pattern: str) -> tiktoken.Encoding:
    """The encoding of a local file of base64 tokens and ranks."""
    with open(rank_path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}
    return tiktoken.Encoding("local-ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def safe_parts(text: str, size: int = LONG) -> Iterator[str]:
    """Parts of ``text`` whose ids, one after another, are those of the whole text.

    A cut is made only between a character that isn't white space and a white space one. No
    alternative of the pattern matches across such a place, nor looks ahead over it from before.
    A stretch without such a place stays whole.
    """
    at = 0
    while len(text) - at > size:
        cut = SAFE.search(text, at + size - 1)
        if cut is None:
            break
        yield text[at : cut.end()]
        at = cut.end()
    yield text[at:]


def _matches_white_runs(pattern: str) -> bool:
    """Whether white space is matched as in ``_WHITE_RULE`` alone: a run but its last character, or at the end a whole run."""
    return pattern.endswith(_WHITE_RULE) and r"\s" not in pattern.removesuffix(_WHITE_RULE).replace(r"[^\s", "")


def encode_text(enc: tiktoken.Encoding, text: str | None) -> list[int]:
    """Ids of a whole text, also where the library's pattern engine would overflow on a run of about a million white-space characters.

    Where a run begins a match ends, and all of it but its last character is one match (the whole of it at the text's
    end), so it is encoded by the ranks alone.
    """
    text = text or ""
    if len(text) <= LONG:
        return enc.encode_ordinary(text)
    ids: list[int] = []
    at = 0
    for run in _WHITE_RUN.finditer(text) if _matches_white_runs(enc._pat_str) else ():
        end = run.end() - (run.end() < len(text))
        for part in safe_parts(text[at : run.start()]):
            ids += enc.encode_ordinary(part)
        ids += enc._encode_single_piece(text[run.start() : end])
        at = end
    for part in safe_parts(text[at:]):
        ids += enc.encode_ordinary(part)
    return ids


def encode(df: DataFrame, rank_path: str, pattern: str, text: str = "text", out: str = "ids") -> DataFrame:
    """Add ``out``: array<int> of the ids of the whole ``text``, without special tokens.

    Null and empty texts give an empty array; no other column is read or changed, but a column
    named ``out`` is replaced. Special-token strings in a text are ordinary text.
    """

    @F.arrow_udf("array<int>")
    def ids_of(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        enc = encoding(rank_path, pattern)
        for batch in texts:
            yield pa.array([encode_text(enc, t) for t in batch.to_pylist()], pa.list_(pa.int32()))

    return df.withColumn(out, ids_of(F.col(text)))


def decode(df: DataFrame, rank_path: str, pattern: str, ids: str = "ids", out: str = "bytes") -> DataFrame:
    """Add ``out``: the raw bytes of ``ids``, which need not be valid UTF-8; null ids give null."""

    @F.arrow_udf("binary")
    def bytes_of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        enc = encoding(rank_path, pattern)
        for batch in batches:
            yield pa.array([None if x is None else enc.decode_bytes(x) for x in batch.to_pylist()], pa.binary())

    return df.withColumn(out, bytes_of(F.col(ids)))


def round_trip(df: DataFrame, rank_path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode each whole ``text``, decode the ids, and return digests of both.

    Columns: the key, ``n_tokens``, ``ids_sha256`` (lower-case hex of the decimal ids joined by
    one space) and ``decoded_sha256`` (lower-case hex of the decoded bytes). A null text counts
    as empty. One row for each row of ``df``, repeated rows and null keys included, of texts of any length and make. Ids
    and bytes stay in the worker, so a text crosses to Python once.
    """
    schema = df.select(F.col(key)).schema.add("n_tokens", "long").add("ids_sha256", "string").add("decoded_sha256", "string")

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(rank_path, pattern)
        name = [str(i) for i in range(enc.n_vocab)]
        for batch in batches:
            n, ids_hex, bytes_hex = [], [], []
            for t in batch.column(1):
                ids = encode_text(enc, t.as_py())
                n.append(len(ids))
                ids_hex.append(sha256(" ".join([name[i] for i in ids]).encode()).hexdigest())
                bytes_hex.append(sha256(enc.decode_bytes(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(ids_hex, pa.string()), pa.array(bytes_hex, pa.string())],
                names=[key, "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return df.select(key, text).mapInArrow(digests, schema)
