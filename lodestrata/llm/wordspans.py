"""Words of whole Arrow batches, found and hashed with NumPy on the UTF-8 bytes.

A word is ``[^\\x20\\x09-\\x0D]+``. Its 64-bit hash takes in eight bytes at a time, each time mixed with
what came before (one step for all words that are long enough, so no loop over words); words of more
than ``LONG`` bytes are hashed by XXH64. No sum of powers is involved, for which words of equal sums
can be written down. Where a hash stands for a word, ``same_words`` compares the bytes themselves.
Texts are worked on in slices of about a MB, cut between documents, or between words inside a very long
document, so memory doesn't follow the size of an Arrow batch or of a document's text.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from xxhash import xxh64_intdigest

SLICE_BYTES, LONG = 1 << 20, 64
_LOW_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    out[1:] = np.uint64(base)
    return np.multiply.accumulate(out)


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads each 64-bit value over all bits (the splitmix64 finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x = x * np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and its row offsets; a null counts as the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def _space(data: np.ndarray) -> np.ndarray:
    return (data == 32) | ((data - np.uint8(9)) < 5)


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First bytes and ends of all words; a word never crosses a row's end."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = ~_space(data)
    before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    cuts = offsets[(offsets > 0) & (offsets < len(data))]
    before[cuts], after[cuts - 1] = False, False
    return np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1


def _eights(data: np.ndarray, roomy: bool = False) -> np.ndarray:
    """Entry i: the eight bytes from i on as one little-endian number. roomy: ``data`` ends with eight bytes of no word."""
    padded = data if roomy else np.concatenate([data, np.zeros(8, np.uint8)])
    return np.ndarray(len(padded) - 7, "<u8", padded, strides=(1,))


def hashed(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 42) -> np.ndarray:
    """The hash of each ``data[start:end]``."""
    size, eights = ends - starts, _eights(data)
    out = mix(size.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))
    left, at = np.flatnonzero((size > 0) & (size <= LONG)), 0
    while len(left):
        now = eights[starts[left] + at] & _LOW_BYTES[np.minimum(size[left] - at, 8)]
        out[left] = mix(out[left] ^ now)
        at += 8
        left = left[size[left] > at]
    for i in np.flatnonzero(size > LONG).tolist():
        out[i] = xxh64_intdigest(data[starts[i] : ends[i]].tobytes(), seed)
    return out


def same_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, others: np.ndarray, other_starts: np.ndarray, other_ends: np.ndarray, roomy: bool = False) -> np.ndarray:
    """Whether each ``data[start:end]`` has the bytes of its partner in ``others`` (roomy: with eight bytes of no word at its end)."""
    size = ends - starts
    same = size == other_ends - other_starts
    a = _eights(data)
    b = a if others is data else _eights(others, roomy)
    left, at = np.flatnonzero(same & (size > 0) & (size <= LONG)), 0
    while len(left):
        wanted = _LOW_BYTES[np.minimum(size[left] - at, 8)]
        ok = ((a[starts[left] + at] ^ b[other_starts[left] + at]) & wanted) == 0
        same[left[~ok]] = False
        at += 8
        left = left[ok & (size[left] > at)]
    for i in np.flatnonzero(same & (size > LONG)).tolist():
        same[i] = np.array_equal(data[starts[i] : ends[i]], others[other_starts[i] : other_ends[i]])
    return same


def _slices(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """(first row, end row, first byte, end byte); rows that don't fit come in pieces cut after white space."""
    row, rows = 0, len(offsets) - 1
    while row < rows:
        end = int(np.searchsorted(offsets, offsets[row] + SLICE_BYTES, side="right")) - 1
        if end > row:
            yield row, end, int(offsets[row]), int(offsets[end])
            row = end
            continue
        at, last = int(offsets[row]), int(offsets[row + 1])
        while at < last:
            cut = min(last, at + SLICE_BYTES)
            if cut < last:
                gaps = np.flatnonzero(_space(data[at:cut]))
                if len(gaps):
                    cut = at + int(gaps[-1]) + 1
                else:  # one word longer than a slice: it goes on up to the next white space of its row
                    while cut < last:
                        gaps = np.flatnonzero(_space(data[cut : min(last, cut + SLICE_BYTES)]))
                        cut = cut + int(gaps[0]) if len(gaps) else min(last, cut + SLICE_BYTES)
                        if len(gaps):
                            break
            yield row, row + 1, at, cut
            at = cut
        row += 1


def folded_bytes(punctuation: bool = True) -> np.ndarray:
    """A byte map for ``word_hashes``: A-Z to a-z and, if asked for, ASCII punctuation to spaces."""
    out = np.arange(256, dtype=np.uint8)
    out[65:91] += 32
    if punctuation:
        plain = np.array([chr(i).isalnum() for i in range(128)])
        out[np.flatnonzero(~plain & (np.arange(128) > 32) & (np.arange(128) < 127))] = 32
    return out


def word_hashes(data: np.ndarray, offsets: np.ndarray, fold: np.ndarray | None = None, seed: int = 42) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of the words of all rows, and the offsets of the rows in them. fold: what each byte counts as. Hashes of two seeds are two independent ones."""
    found, counts = [], np.zeros(len(offsets) - 1, np.int64)
    for row, end, at, cut in _slices(data, offsets):
        piece = data[at:cut]
        if fold is not None:
            piece = fold[piece]
        local = np.clip(offsets[row : end + 1] - at, 0, cut - at)
        starts, ends = word_bounds(piece, local)
        found.append(hashed(piece, starts, ends, seed))
        counts[row:end] += np.diff(np.searchsorted(starts, local))
    return (np.concatenate(found) if found else np.zeros(0, np.uint64)), np.concatenate([[0], np.cumsum(counts)])


@lru_cache(8)
def _gram_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    base = 0xC2B2AE3D27D4EB4F | 1
    return _powers(base, n), _powers(pow(base, -1, 1 << 64), n)


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Running Karp-Rabin hashes of every ``k`` consecutive words: entry i is that of ``words[i:i + k]``."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    size = 1 << max(16, (len(words)).bit_length())
    power, inverse = _gram_tables(size)
    sums = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * power[: len(words)], out=sums[1:])
    return mix((sums[k:] - sums[:-k]) * inverse[:n])


def window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Entry i is the least of ``values[i:i + width]``, by doubling."""
    n = len(values) - width + 1
    if n <= 0:
        return values[:0]
    span, least = 1, values
    while span * 2 <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    return np.minimum(least[:n], least[width - span : width - span + n])
