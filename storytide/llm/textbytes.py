"""Numpy views of text columns: words and hashes without a Python object per word.

A text column of an Arrow batch is one byte buffer and one array of offsets. The functions
here work on such buffers in chunks of a megabyte, so memory does not depend on the
batch; a single text above the chunk size is its own chunk. Null texts are empty.

Hashes are polynomials modulo 2**64 over random byte values with an odd base, so that the
hash of any substring comes from one running sum; they are finished by a bijective mix. Modulo a
power of two there are long strings that collide for every base (Thue-Morse words and their
complements, from about 1,000 letters), so :func:`hashed` adds a polynomial modulo a prime and
the length. Where equal hashes must mean equal bytes, :func:`same_bytes` compares those.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard

CHUNK_BYTES = 1 << 20


def _give_memory_back() -> None:
    """Let large arrays go back to the system when they are freed: a Python worker lives for many
    tasks beside the executor's heap."""
    try:
        ctypes.CDLL(None).mallopt(-3, 1 << 22)  # M_MMAP_THRESHOLD
    except (AttributeError, OSError):  # another C library
        return
    pa.set_memory_pool(pa.system_memory_pool())


_give_memory_back()
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_PRIME = np.uint64((1 << 31) - 1)
_PRIME_BASE = 1_193_046_471

SPACES = np.zeros(256, bool)
SPACES[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def _values(seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


BYTE_VALUES = _values(20)
LOWER_VALUES = BYTE_VALUES.copy()
LOWER_VALUES[65:91] = BYTE_VALUES[97:123]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose bits all depend on all bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=2)
def _powers(base: int, size: int) -> np.ndarray:
    out = np.empty(size, np.uint64)
    out[0] = 1
    done = 1
    while done < size:
        step = min(done, size - done)
        out[done : done + step] = out[:step] * np.uint64(pow(base, done, 1 << 64))
        done += step
    return out


def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    size = max(CHUNK_BYTES + 1, size)
    return _powers(_BASE, size), _powers(_INVERSE, size)


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of consecutive rows whose bytes stay near ``limit``."""
    if pa.types.is_null(column.type):
        column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    kind = np.int64 if wide else np.int32
    _, offsets, data = column.buffers()
    if not len(column):
        return
    ends = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        stop = int(np.searchsorted(ends, ends[row] + limit, side="right")) - 1
        stop = min(max(stop, row + 1), len(column))
        yield row, raw[ends[row] : ends[stop]], ends[row : stop + 1] - ends[row]
        row = stop


def running(data: np.ndarray, values: np.ndarray = BYTE_VALUES) -> np.ndarray:
    """Sums from which :func:`spans` takes the hash of any substring."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(values[data] * powers(len(data) + 1)[0][: len(data)], out=out[1:])
    return out


def spans(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the substrings [start, end); their lengths are not part of the hash."""
    return (sums[ends] - sums[starts]) * powers(len(sums))[1][starts]


def _folded(x: np.ndarray) -> np.ndarray:
    """Modulo the prime 2**31 - 1, up to one multiple of it."""
    return (x & _PRIME) + (x >> np.uint64(31))


@lru_cache(maxsize=2)
def _prime_powers(base: int, size: int) -> np.ndarray:
    out = np.empty(size, np.uint32)
    out[0] = 1
    done = 1
    while done < size:
        step = min(done, size - done)
        out[done : done + step] = out[:step].astype(np.uint64) * np.uint64(pow(base, done, int(_PRIME))) % _PRIME
        done += step
    return out


def hashed(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, values: np.ndarray = BYTE_VALUES) -> np.ndarray:
    """Hashes of the substrings [start, end) by two polynomials and the length."""
    size = max(CHUNK_BYTES + 1, len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)  # terms below 2**32: exact up to four billion bytes
    terms = (values % _PRIME)[data]
    terms *= _prime_powers(_PRIME_BASE, size)[: len(data)]
    np.cumsum(_folded(terms), out=sums[1:])
    del terms
    back = _prime_powers(pow(_PRIME_BASE, -1, int(_PRIME)), size)
    second = (sums[ends] - sums[starts]) % _PRIME * back[starts] % _PRIME
    second = second << np.uint64(33) | (ends - starts).astype(np.uint64)
    return mix(spans(running(data, values), starts, ends) + mix(second))


def same_bytes(a: np.ndarray, a_starts: np.ndarray, b: np.ndarray, b_starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Whether the substrings of ``a`` and ``b`` that begin there and are so long are equal."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    kind = np.int32 if max(len(a), len(b), total) < 1 << 31 else np.int64  # indices are most of the work
    begins = (ends - lengths).astype(kind)
    at = np.arange(total, dtype=kind)
    other = a[np.repeat(a_starts.astype(kind) - begins, lengths) + at] != b[np.repeat(b_starts.astype(kind) - begins, lengths) + at]
    wrong = np.flatnonzero(other)
    out = np.ones(len(lengths), bool)
    out[np.searchsorted(ends, wrong, side="right")] = False
    return out


def words(
    data: np.ndarray, offsets: np.ndarray, separators: np.ndarray = SPACES, kinds: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and for each row the number of its first word.

    ``kinds``: words are also cut where a byte of kind 1 meets one of kind 2.
    """
    inside = ~separators[data]
    begins, stops = inside.copy(), inside.copy()
    within = inside[1:] & inside[:-1]
    if kinds is not None:
        kind = kinds[data]
        within &= (kind[1:] | kind[:-1]) != 3
    begins[1:] &= ~within
    stops[:-1] &= ~within
    edges = offsets[:-1][offsets[:-1] < len(data)]
    begins[edges] = inside[edges]
    edges = offsets[1:] - 1
    edges = edges[edges >= 0]
    stops[edges] = inside[edges]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(stops) + 1, np.searchsorted(starts, offsets)


def planes(x: np.ndarray) -> bytes:
    """The bytes of numbers, all first bytes before all second ones: high zeros compress."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T).tobytes()


def numbers(raw: bytes, kind) -> np.ndarray:
    """Back from :func:`planes`."""
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(width, -1).T).view(kind).ravel()


def squeezed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches with ``text`` compressed, for a shuffle that carries whole texts."""
    packer = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        texts = (x.as_buffer() for x in batch.column("text").cast(pa.large_binary()))
        packed = pa.array([packer.compress(x) if x is not None else None for x in texts], pa.binary())
        yield batch.set_column(batch.schema.get_field_index("text"), "text", packed)
