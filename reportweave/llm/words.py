"""Words of many texts at once, in numpy and Arrow, for operators that count or match words."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa

from reportweave.llm.batches import slices
from reportweave.llm.sketch import mix

GROUP_BYTES = 6 * 1024 * 1024


def byte_table(characters: bytes) -> np.ndarray:
    """A table of 256 booleans that says which bytes are among ``characters``."""
    table = np.zeros(256, bool)
    table[list(characters)] = True
    return table


def groups(batches: Iterable[pa.RecordBatch], limit: int = GROUP_BYTES) -> Iterator[pa.RecordBatch]:
    """Rows gathered to batches of about ``limit`` bytes; a longer row comes alone."""
    held: list[pa.RecordBatch] = []
    size = 0
    for whole in batches:
        for batch in slices(whole, limit):
            if not batch.num_rows:
                continue
            if held and size + batch.nbytes > limit:
                yield pa.concat_batches(held)
                held, size = [], 0
            held.append(batch)
            size += batch.nbytes
    if held:
        yield pa.concat_batches(held)


def joined(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts as bytes, each ended by a line end, and where each starts; null counts as empty."""
    values = [t or b"" for t in texts.cast(pa.binary()).to_pylist()]
    lengths = np.fromiter(map(len, values), np.int64, len(values)) + 1
    raw = np.frombuffer(b"".join(v + b"\n" for v in values), np.uint8)
    return raw, np.cumsum(lengths) - lengths


def cut(raw: np.ndarray, blank: np.ndarray) -> tuple[np.ndarray, np.ndarray, pa.DictionaryArray]:
    """Start and end of every run of bytes that are not ``blank``, and the runs as a dictionary.

    ``raw`` ends with a blank byte.
    """
    inside = ~blank[raw]
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if len(raw) and inside[0]:
        edges = np.concatenate(([0], edges))
    starts, ends = edges[0::2], edges[1::2]
    offsets = np.concatenate(([0], np.cumsum(ends - starts)))
    runs = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(raw[inside])]
    )
    return starts, ends, runs.dictionary_encode()


def value_hashes(values: pa.Array, seed: str = "") -> np.ndarray:
    """64-bit hashes of strings or bytes, the same in every worker; ``seed`` makes other ones."""
    found = np.array(values.cast(pa.binary()).to_pylist() + [seed.encode()], object)
    hashes = pd.util.hash_array(found, categorize=False)
    return mix(hashes[:-1] ^ hashes[-1])
