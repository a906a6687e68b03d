"""Words of whole Arrow batches as numpy arrays, without a loop over words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
#: Texts are worked on in slices of about this many bytes; one longer text makes a slice of its own.
SLICE_BYTES = 1 << 19

_seeds = np.random.default_rng(20240501)
#: A random value per byte, and the odd base of the polynomial with its inverse modulo 2**64.
BYTE_VALUE = _seeds.integers(1, 2**63, 256, dtype=U64) | U64(1)
BASE = int(_seeds.integers(2**61, 2**63)) * 2 + 1
INVERSE = pow(BASE, -1, 2**64)
#: Bytes between words: white space only, or all of ASCII but letters and digits.
WHITE = np.zeros(256, dtype=bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
NO_LETTER = np.array([i < 128 and not chr(i).isalnum() for i in range(256)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_powers: list[np.ndarray] = []


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x ^ (x >> U64(33))
    x = x * U64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> U64(33))
    x = x * U64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U64(33))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        size = max(n, SLICE_BYTES * 2)
        made = []
        for base in (BASE, INVERSE):
            steps = np.full(size, base, dtype=U64)
            steps[0] = 1
            made.append(np.cumprod(steps, dtype=U64))
        _powers[:] = made
    return _powers[0][:n], _powers[1][:n]


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts behind each other, and the offsets of each text in them. Null counts as empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if data is None or not len(ends):
        return np.zeros(0, dtype=np.uint8), np.zeros(len(texts) + 1, dtype=np.int64)
    return np.frombuffer(data, dtype=np.uint8)[ends[0] : ends[-1]], ends - ends[0]


def rows_of(*columns: pa.Array, size: int = 256) -> Iterator[tuple]:
    """The rows of some columns as Python values, a few hundred at a time in memory."""
    for first in range(0, len(columns[0]), size):
        yield from zip(*(c.slice(first, size).to_pylist() for c in columns))


def release() -> None:
    """Give memory that Arrow keeps for later back to the system; Python workers live on between tasks."""
    pa.default_memory_pool().release_unused()


def slices(offsets: np.ndarray, size: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about `size` bytes together."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + size, side="right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


def word_spans(data: np.ndarray, offsets: np.ndarray, between: np.ndarray = WHITE) -> tuple[np.ndarray, np.ndarray]:
    """First byte of each word in order, and the byte behind it; words end where texts do. `between` tells which bytes
    separate words."""
    n = len(data)
    inside = ~between[data]
    edge = np.zeros(n + 1, dtype=bool)
    edge[offsets] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:n]
    stops = inside.copy()
    stops[:-1] &= ~inside[1:] | edge[1:n]
    return np.flatnonzero(begins), np.flatnonzero(stops) + 1


def span_hashes(data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """The 64-bit hash of each span of bytes, A-Z lower-cased."""
    n = len(data)
    power, inverse = _power_tables(n)
    sums = np.zeros(n + 1, dtype=U64)
    np.cumsum(BYTE_VALUE[_LOWER[data]] * power, out=sums[1:])
    return mix((sums[stop] - sums[start]) * inverse[start] + (stop - start).astype(U64))


def words(data: np.ndarray, offsets: np.ndarray, between: np.ndarray = WHITE) -> tuple[np.ndarray, np.ndarray]:
    """The 64-bit hash of each word in order, A-Z lower-cased, and the first word of each text (one entry more than
    texts). `between` tells which bytes separate words."""
    if len(data) == 0:
        return np.zeros(0, dtype=U64), np.zeros(len(offsets), dtype=np.int64)
    start, stop = word_spans(data, offsets, between)
    return span_hashes(data, start, stop), np.searchsorted(start, offsets)


def rolled(hashes: np.ndarray, size: int) -> np.ndarray:
    """The hash of every `size` words in a row."""
    place = mix(np.arange(1, size + 1, dtype=U64)) | U64(1)
    n = max(len(hashes) - size + 1, 0)
    sums = np.full(n, size, dtype=U64)
    for j in range(size if n else 0):
        sums += hashes[j : j + n] * place[j]
    return mix(sums)


def shingles(hashes: np.ndarray, firsts: np.ndarray, size: int) -> list[np.ndarray]:
    """The sorted distinct shingles of `size` words of each text; a text of fewer words has its whole sequence as
    one shingle, a text without words has none."""
    place = mix(np.arange(1, size + 1, dtype=U64)) | U64(1)
    n = len(hashes) - size + 1
    rolled = np.zeros(max(n, 0), dtype=U64)
    for j in range(size if n > 0 else 0):
        rolled += hashes[j : j + n] * place[j]
    rolled = mix(rolled)
    sets = []
    for a, b in zip(firsts[:-1].tolist(), firsts[1:].tolist()):
        if b - a >= size:
            found = np.sort(rolled[a : b - size + 1])
            keep = np.ones(len(found), dtype=bool)
            np.not_equal(found[1:], found[:-1], out=keep[1:])
            sets.append(found[keep])
        elif b > a:
            short = (hashes[a:b] * place[: b - a]).sum(dtype=U64) + U64(b - a)
            sets.append(mix(np.array([short], dtype=U64) ^ U64(0x5BD1E995)))
        else:
            sets.append(np.zeros(0, dtype=U64))
    return sets
