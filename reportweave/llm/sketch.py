"""Shingle sets and HyperMinHash sketches, in numpy, for a batch of texts at a time."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np

BANDS, BAND_WIDTH = 48, 6
REGISTERS = BANDS * BAND_WIDTH
MANTISSA_BITS = 10
BAND_BYTES = 2 * BAND_WIDTH
WINDOW = 1 << 18  # bytes hashed at once

_RANDOM = np.random.default_rng(20_240_601)
_BYTE = _RANDOM.integers(0, 2**63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_PLACE = _RANDOM.integers(0, 2**63, 64, np.uint64) * np.uint64(2) + np.uint64(1)
# Which filled register an empty one borrows from: the one of lowest rank in its row.
_BORROW = _RANDOM.permuted(np.tile(np.arange(REGISTERS, dtype=np.uint16), (REGISTERS, 1)), axis=1)
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _hash_window(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of every word in bytes that end with a blank."""
    blank = _BLANK[raw]
    before = np.concatenate(([True], blank[:-1]))
    starts = np.flatnonzero(~blank & before)
    if not len(starts):
        return starts, np.zeros(0, np.uint64)
    ends = np.flatnonzero(blank & ~before)
    place = np.arange(len(raw)) - np.repeat(
        np.concatenate(([0], starts)), np.diff(np.concatenate(([0], starts, [len(raw)])))
    )
    longest = int((ends - starts).max())
    powers = np.cumprod(np.full(longest + 1, _BASE))
    value = _BYTE[raw] * powers[np.minimum(place, longest)]
    value[blank] = 0
    return starts, mix(np.add.reduceat(value, starts) + (ends - starts).astype(np.uint64))


def word_hashes(texts: Sequence[bytes]) -> Iterator[np.ndarray]:
    """Hashes of the words of each text: lower-cased A-Z, between ASCII blanks.

    Texts are hashed together in windows that end between words; a long text takes several.
    """
    group: list[bytes] = []
    size = 0

    def flush() -> Iterator[np.ndarray]:
        joined = b" ".join(group) + b" "
        starts, hashes = _hash_window(np.frombuffer(joined, np.uint8))
        bounds = np.cumsum([0] + [len(t) + 1 for t in group])
        at = np.searchsorted(starts, bounds)
        for i in range(len(group)):
            yield hashes[at[i] : at[i + 1]]

    for text in texts:
        text = text.lower()
        if len(text) > WINDOW:
            yield from flush() if group else ()
            group, size = [], 0
            yield np.concatenate([h for part in _windows(text) for h in word_hashes([part])])
            continue
        if size + len(text) > WINDOW:
            yield from flush()
            group, size = [], 0
        group.append(text)
        size += len(text) + 1
    if group:
        yield from flush()


def _windows(text: bytes) -> Iterator[bytes]:
    """Parts of a long text cut between words; a word longer than a window is not cut."""
    at = 0
    while at < len(text):
        stop = at + WINDOW
        if stop >= len(text):
            yield text[at:] if len(text) - at <= WINDOW else text[at:stop]
            return
        cut = max(text.rfind(c, at, stop) for c in (b" ", b"\n", b"\t", b"\r", b"\v", b"\f"))
        if cut < at:
            later = [p for c in (b" ", b"\n", b"\t", b"\r", b"\v", b"\f") if (p := text.find(c, stop)) >= 0]
            cut = min(later, default=len(text))
            yield from _long_word(text[at:cut])
        else:
            yield text[at:cut]
        at = cut + 1


def _long_word(word: bytes) -> Iterator[bytes]:
    """Stands for one word longer than a window: its digest, as one word."""
    yield hashlib.sha256(word).hexdigest().encode()


def shingle_sets(texts: Sequence[str | None], width: int) -> Iterator[np.ndarray]:
    """Sorted distinct hashes of the word shingles of each text.

    Fewer than ``width`` words make one shingle of the whole sequence; no words make none.
    """
    places = _PLACE[:width]
    for words in word_hashes([(t or "").encode() for t in texts]):
        n = len(words)
        if not n:
            yield words
        elif n < width:
            yield mix((words * places[:n]).sum(dtype=np.uint64, keepdims=True) + np.uint64(n))
        else:
            joined = words[: n - width + 1] * places[0]
            for k in range(1, width):
                joined = joined + words[k : n - width + 1 + k] * places[k]
            yield np.unique(mix(joined))


def registers(shingles: np.ndarray) -> np.ndarray:
    """The sketch of a non-empty set: leading zeros and mantissa of the least hash per bucket.

    A bucket without shingles borrows the register of a filled bucket, chosen by a fixed random
    order, so that equal sets have equal sketches and registers agree as often as the sets do.
    """
    bucket = ((shingles >> np.uint64(32)) * np.uint64(REGISTERS)) >> np.uint64(32)
    filled, first = np.unique(bucket.astype(np.int64), return_index=True)  # sorted already
    least = np.minimum.reduceat(mix(shingles ^ _BASE), first)
    exponent = np.frexp((least >> np.uint64(11)).astype(np.float64))[1]
    zeros = (53 - exponent).astype(np.uint64)
    mantissa = (least << (zeros + np.uint64(1))) >> np.uint64(64 - MANTISSA_BITS)
    out = np.zeros(REGISTERS, np.uint16)
    out[filled] = ((zeros << np.uint64(MANTISSA_BITS)) | mantissa).astype(np.uint16)
    if len(filled) < REGISTERS:
        empty = np.setdiff1d(np.arange(REGISTERS), filled, assume_unique=True)
        out[empty] = out[filled[_BORROW[empty][:, filled].argmin(axis=1)]]
    return out


def set_digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def collision_rate(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """How often registers of unrelated sets of these sizes agree by chance."""
    a, b = np.maximum(n / REGISTERS, 1.0), np.maximum(m / REGISTERS, 1.0)
    rate, total = np.zeros_like(a), a + b
    for zeros in range(54):
        low, high = 2.0 ** -(zeros + 1), 2.0**-zeros
        cell = low / 2**MANTISSA_BITS
        rate += cell * a * b / total * (np.exp(-total * low) - np.exp(-total * high))
    return rate


def estimated_jaccard(agreeing: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Similarity from the share of agreeing registers, corrected for chance."""
    rate = collision_rate(np.asarray(n, float), np.asarray(m, float))
    return np.clip((agreeing - rate) / (1 - rate), 0.0, 1.0)


def estimate_cut(n: np.ndarray, m: np.ndarray, threshold: float) -> np.ndarray:
    """Least estimate that a pair of that similarity has, but for 4.5 standard deviations."""
    size = np.minimum(REGISTERS, np.minimum(n, m)).astype(float)
    return threshold - 4.5 * np.sqrt(threshold * (1 - threshold) / np.maximum(size, 1))
