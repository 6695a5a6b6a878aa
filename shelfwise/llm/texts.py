"""Whole texts as numpy arrays inside tasks: bytes, words, word hashes, n-gram counts.

Arrow hands a task the UTF-8 bytes of many texts in one buffer. Everything here
works on that buffer at once; nothing loops over words in Python. Buffers are
cut between documents into pieces of about ``PIECE`` bytes so that the memory
of a task does not depend on the batch (a single longer text is one piece).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE = 1 << 20
HASHED_AT_ONCE = 1 << 19
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"

U = np.uint64
_MULT = 0x9E3779B97F4A7C15
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACES)] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_powers = np.ones(1, U)
_inverse = np.ones(1, U)


def _power_tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd multiplier and of its inverse modulo 2^64."""
    global _powers, _inverse
    if len(_powers) < size:
        size = max(size, 1 << 16)
        steps = np.full(size, _MULT, U)
        steps[0] = 1
        _powers = np.cumprod(steps, dtype=U)
        steps[1:] = U(pow(_MULT, -1, 1 << 64))
        _inverse = np.cumprod(steps, dtype=U)
    return _powers, _inverse


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser; every input bit reaches every output bit."""
    x = x.astype(U, copy=True)
    x ^= x >> U(30)
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def as_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and its row offsets; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset: column.offset + len(column) + 1]
    if data is None or not len(at):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0]: at[-1]], at - at[0]


def pieces(column: pa.Array, size: int = PIECE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) for runs of rows of about ``size`` bytes."""
    data, at = as_bytes(column)
    first, n = 0, len(at) - 1
    while first < n:
        end = int(np.searchsorted(at, at[first] + size, "right")) - 1
        end = min(max(end, first + 1), n)
        yield first, end, data[at[first]: at[end]], at[first: end + 1] - at[first]
        first = end


def word_bounds(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and row numbers of the words (runs without ASCII white space)."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none
    space = _IS_SPACE[data]
    inside = ~space
    first, last = inside.copy(), inside.copy()
    first[1:] &= space[:-1]
    last[:-1] &= space[1:]
    heads = at[:-1][np.diff(at) > 0]
    first[heads] = inside[heads]
    tails = at[1:][np.diff(at) > 0] - 1
    last[tails] = inside[tails]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(at, starts, "right") - 1


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word: a polynomial over its bytes, finalised with its length."""
    out = np.empty(len(starts), U)
    done = 0
    while done < len(starts):
        low = starts[done]
        stop = max(done + 1, int(np.searchsorted(ends, low + HASHED_AT_ONCE, "right")))
        high = ends[stop - 1]
        powers, inverse = _power_tables(int(high - low))
        sums = np.zeros(high - low + 1, U)
        np.cumsum((data[low:high].astype(U) + U(1)) * powers[: high - low], out=sums[1:])
        s, e = starts[done:stop] - low, ends[done:stop] - low
        out[done:stop] = (sums[e] - sums[s]) * inverse[s] + (e - s).astype(U) * U(0xD6E8FEB86659FD93)
        done = stop
    return mix(out)


def hashed_words(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and row numbers of all words, A-Z lower-cased."""
    data = LOWER[data]
    starts, ends, rows = word_bounds(data, at)
    return word_hashes(data, starts, ends), rows


def code_counts(rows: np.ndarray, codes: np.ndarray, n_rows: int, size: int) -> np.ndarray:
    """A dense table of how often each code occurs in each row."""
    flat = np.bincount(rows.astype(np.int64) * size + codes, minlength=n_rows * size)
    return flat.reshape(n_rows, size)


def hash_of(text: str) -> int:
    """The hash that ``hashed_words`` gives a single word."""
    column = pa.array([text])
    return int(hashed_words(*as_bytes(column))[0][0])


def coded_words(data: np.ndarray, at: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct words, and per word its place among them, its start, its end and its row.

    Unlike a hash this tells any two words apart.
    """
    starts, ends, rows = word_bounds(data, at)
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=offsets[1:])
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [
        None, pa.py_buffer(offsets), pa.py_buffer(data[~_IS_SPACE[data]])])
    coded = words.dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), starts, ends, rows
