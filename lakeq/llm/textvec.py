"""Tokenising whole Arrow string columns with numpy.

A column's UTF-8 buffer is handled as one byte array, some megabytes at a time,
so the cost per word is that of a few array passes instead of a Python call.
Hashes are 64-bit and the same in every process.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20

_U = np.uint64
_rng = np.random.Generator(np.random.PCG64(20240611))
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * _U(2) + _U(1)
_STEP = _U(0x9E3779B97F4A7C15)
_STEP_INV = _U(pow(0x9E3779B97F4A7C15, -1, 2**64))
MIX = _rng.integers(1, 2**63, 64, dtype=np.uint64) * _U(2) + _U(1)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """STEP**i and STEP**-i modulo 2**64 for i < n."""
    if len(_powers[0]) < n:
        size = max(n, SLICE_BYTES)
        for i, step in enumerate((_STEP, _STEP_INV)):
            p = np.full(size, step, np.uint64)
            p[0] = 1
            _powers[i] = np.multiply.accumulate(p)
    return _powers[0][:n], _powers[1][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread a 64-bit value over all its bits (the public splitmix64 finaliser)."""
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def utf8(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets (n + 1) of a string column; a null row is empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("")
    col = col.cast(pa.large_binary())
    if len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offs = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + len(col) + 1]
    buf = col.buffers()[2]
    data = np.frombuffer(buf, np.uint8) if buf is not None else np.zeros(0, np.uint8)
    return data[offs[0]:offs[-1]], offs - offs[0]


def slices(col: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Row ranges of about ``limit`` bytes: (first row, end row, bytes, offsets)."""
    data, offs = utf8(col)
    at, n = 0, len(offs) - 1
    while at < n:
        end = max(at + 1, int(np.searchsorted(offs, offs[at] + limit, "right")) - 1)
        end = min(end, n)
        yield at, end, data[offs[at]:offs[end]], offs[at:end + 1] - offs[at]
        at = end


def lower(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z, other bytes unchanged."""
    return _LOWER[data]


def spans(inside: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every run of True that does not cross a row boundary."""
    if not len(inside):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    cut = offs[(offs > 0) & (offs < len(inside))]
    before = np.empty_like(inside)
    before[0] = False
    before[1:] = inside[:-1]
    before[cut] = False
    after = np.empty_like(inside)
    after[-1] = False
    after[:-1] = inside[1:]
    after[cut - 1] = False
    return np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1


def rolling(data: np.ndarray) -> np.ndarray:
    """Prefix sums from which ``span_hash`` takes the hash of any byte span."""
    power, _ = _power(len(data))
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * power, out=out[1:])
    return out


def span_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes in each [start, end)."""
    if not len(start):
        return np.zeros(0, np.uint64)
    _, inverse = _power(len(sums))
    return mix((sums[end] - sums[start]) * inverse[start] + (end - start).astype(np.uint64) * MIX[63])


def words(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every word, a run of bytes other than ASCII white space."""
    return spans(~SPACE[data], offs)


def row_of(offs: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The row that holds each byte position."""
    return np.searchsorted(offs, at, "right") - 1


def word_counts(col: pa.Array) -> np.ndarray:
    """Words of each row."""
    out = [np.zeros(0, np.int64)]
    for at, end, data, offs in slices(col):
        start, _ = words(data, offs)
        out.append(np.bincount(row_of(offs, start), minlength=end - at).astype(np.int64))
    return np.concatenate(out)


def shingles(data: np.ndarray, offs: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the k-word shingles of lower-cased rows, and the row offsets into
    them. A row of fewer words has its whole sequence as one shingle, a row
    without words none. Repeats are kept."""
    low = lower(data)
    start, end = words(low, offs)
    h = span_hash(rolling(low), start, end)
    per = np.bincount(row_of(offs, start), minlength=len(offs) - 1)
    first = np.concatenate(([0], np.cumsum(per)))
    n = np.where(per >= k, per - k + 1, np.minimum(per, 1))
    to = np.concatenate(([0], np.cumsum(n)))
    if not len(h):
        return h, to
    word = np.repeat(first[:-1] - to[:-1], n) + np.arange(to[-1])
    length = np.repeat(np.minimum(per, k), n)
    out = length.astype(np.uint64) * MIX[62]
    for j in range(k):
        has = length > j
        out += np.where(has, h[np.minimum(word + j, len(h) - 1)] * MIX[j], _U(0))
    return mix(out), to


def ngrams(data: np.ndarray, n: int, bits: int) -> np.ndarray:
    """Hashed bucket (of 2**bits) of the n bytes from each position, n <= 7."""
    size = len(data) - n + 1
    if size <= 0:
        return np.zeros(0, np.int64)
    code = np.full(size, n << 56, np.uint64)
    for j in range(n):
        code += data[j:j + size].astype(np.uint64) << _U(8 * j)
    return ((code * MIX[61]) >> _U(64 - bits)).astype(np.int64)


def row_sums(values: np.ndarray, offs: np.ndarray, n: int = 1) -> np.ndarray:
    """Per row, the sum of the values of the n-byte windows inside it. ``values``
    (1-d or 2-d, by window start) is changed: windows across rows become 0."""
    out = np.zeros((len(offs) - 1, *values.shape[1:]))
    for j in range(1, n):
        cross = offs[1:-1] - j
        values[cross[(cross >= 0) & (cross < len(values))]] = 0
    some = np.flatnonzero((offs[1:] > offs[:-1]) & (offs[:-1] < len(values)))
    if len(some):
        out[some] = np.add.reduceat(values, offs[:-1][some], axis=0, dtype=np.float64)
    return out


def row_values(values: np.ndarray, offs: np.ndarray, n: int, row: int) -> np.ndarray:
    """The values of the n-byte windows inside one row."""
    return values[offs[row]:max(offs[row], offs[row + 1] - n + 1)]


def row_sums_u64(values: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Per row, the wrapping 64-bit sum of its values."""
    out = np.zeros(len(offs) - 1, np.uint64)
    some = np.flatnonzero(offs[1:] > offs[:-1])
    if len(some):
        out[some] = np.add.reduceat(values, offs[:-1][some])
    return out
