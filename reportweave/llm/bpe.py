"""Byte-level BPE encoding and decoding with tiktoken and a local rank file.

The driver reads the rank file (its size is checked) and broadcasts its bytes; every Python
worker builds the encoding once. Long texts are cut where a match of the pattern must end, so
that the pieces can be encoded apart with the same result as the whole.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reportweave.llm.batches import slices
from reportweave.sources.tables import read_table

RANK_FILE_LIMIT = 16 * 1024 * 1024
SPLIT_OVER = 32_768

_BLANK = r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
_LETTER = r"[A-Za-z\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fa5\uac00-\ud7a3]"
# Places where no match of the pattern can go on: none holds blanks after other characters,
# letters before digits or marks, or digits before letters or marks.
_SAFE = re.compile(
    f"(?<={_LETTER})(?=[ \n0-9!-/:-@\\u3001\\u3002\\uff0c])|(?<=[0-9])(?=[ \nA-Za-z!-/:-@])"
    f"|(?<=[!-/:-@])(?=[ \n])"
)
_BLANK_RUN = re.compile(f"{_BLANK}{{1024,}}")


def read_ranks(path: str) -> bytes:
    """The rank file as it is: one line per token, in base64, and its rank."""
    with open(path, "rb") as file:
        raw = file.read(RANK_FILE_LIMIT + 1)
    if len(raw) > RANK_FILE_LIMIT:
        raise ValueError(f"{path} is longer than {RANK_FILE_LIMIT} bytes")
    return raw


@lru_cache(maxsize=2)
def encodings(raw: bytes, pattern: str) -> tuple[tiktoken.Encoding, tiktoken.Encoding]:
    """The encoding of ``pattern``, and one that takes its whole input as one match."""
    ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, raw.splitlines()) if t}

    def build(pat: str) -> tiktoken.Encoding:
        return tiktoken.Encoding("ranks", pat_str=pat, mergeable_ranks=ranks, special_tokens={})

    return build(pattern), build(r"(?s:.+)")


def _cut(text: str, limit: int) -> Iterator[str]:
    at = 0
    while len(text) - at > limit:
        found = _SAFE.search(text, at + limit)
        if found is None:
            break
        yield text[at : found.start()]
        at = found.start()
    yield text[at:]


def safe_parts(text: str, limit: int = SPLIT_OVER) -> Iterator[tuple[str, bool]]:
    """Parts to encode apart, and whether a part is one match.

    A very long run of blanks is one match up to its last character, or to the end of the
    text; the regex engine itself fails on such runs.
    """
    if len(text) <= limit:
        yield text, False
        return
    at = 0
    for run in _BLANK_RUN.finditer(text):
        for part in _cut(text[at : run.start()], limit):
            yield part, False
        at = run.end() if run.end() == len(text) else run.end() - 1
        yield text[run.start() : at], True
    for part in _cut(text[at:], limit):
        yield part, False


def encode_text(text: str, raw: bytes, pattern: str) -> list[int]:
    """Ids of a text, without special tokens."""
    split, whole = encodings(raw, pattern)
    ids: list[int] = []
    for part, single in safe_parts(text):
        ids += (whole if single else split).encode_ordinary(part)
    return ids


def encode_documents(
    docs: DataFrame,
    rank_path: str,
    pattern: str,
    id: str = "doc_id",
    text: str = "text",
    decode: bool = False,
    verify: bool = False,
) -> DataFrame:
    """``id, n_tokens, ids`` and, with ``decode``, ``decoded``, for every row.

    ``ids`` is binary: token ids as little-endian unsigned 32-bit integers. ``decoded`` are the
    raw bytes that the ids stand for; they need not be valid UTF-8 for ids from elsewhere. A null
    text counts as empty and has no tokens; texts are encoded whole, whatever their length.
    Repeated rows are encoded each; other columns are ignored. With ``verify`` the ids of every row
    are decoded again, and bytes other than the text's are an error.
    """
    raw = docs.sparkSession.sparkContext.broadcast(read_ranks(rank_path))
    rows = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    schema = f"id {kind}, n_tokens bigint, ids binary" + ", decoded binary" * decode

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, _ = encodings(raw.value, pattern)
        for whole in batches:
            for batch in slices(whole):
                sizes, packed, decoded = [], [], []
                for t in batch[1].to_pylist():
                    ids = encode_text(t or "", raw.value, pattern)
                    sizes.append(len(ids))
                    packed.append(np.array(ids, "<u4").tobytes())
                    if not (decode or verify):
                        continue
                    back = split.decode_bytes(ids)
                    if verify and back != (t or "").encode():
                        raise ValueError(f"token ids do not decode to their text: {(t or "")[:80]!r}")
                    if decode:
                        decoded.append(back)
                columns = [batch[0], pa.array(sizes, pa.int64()), pa.array(packed, pa.binary())]
                names = ["id", "n_tokens", "ids"]
                if decode:
                    columns.append(pa.array(decoded, pa.binary()))
                    names.append("decoded")
                yield pa.RecordBatch.from_arrays(columns, names)
        pa.default_memory_pool().release_unused()

    return rows.mapInArrow(encode, schema).withColumnRenamed("id", id)


def decode_ids(rows: DataFrame, rank_path: str, pattern: str, ids: str = "ids") -> DataFrame:
    """``rows`` with ``decoded``: the raw bytes of the ids in the binary column ``ids``."""
    raw = rows.sparkSession.sparkContext.broadcast(read_ranks(rank_path))

    @F.pandas_udf("binary")
    def decoded(column: pd.Series) -> pd.Series:
        split, _ = encodings(raw.value, pattern)
        return column.map(
            lambda b: None if b is None else split.decode_bytes(np.frombuffer(b, "<u4").tolist())
        )

    return rows.withColumn("decoded", decoded(F.col(ids)))


def op5_byte_bpe(spark: SparkSession, sf: str) -> DataFrame:
    import public_tokenizers

    encoded = encode_documents(
        read_table(spark, sf, "documents"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN,
        decode=True,
    )
    return encoded.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
