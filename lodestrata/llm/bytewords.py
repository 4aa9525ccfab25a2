"""Byte-level BPE of whole Arrow columns: words found and looked up with NumPy, new ones encoded by the library.

The byte-level pre-tokenizer cuts a text into words without gaps. For texts whose characters all lie in
a checked set the cuts follow from the classes of neighbouring bytes; every other text goes to the
library as a whole. Words are looked up by hash in a bounded table of words already encoded; the
tokenizers library encodes those it lacks, each once. The table keeps the words' bytes: a word whose
hash is another word's sends its text to the library.
"""

from __future__ import annotations

import json
import os
from functools import lru_cache

import numpy as np

from .wordspans import SLICE_BYTES, hashed, same_words

CACHED_WORDS = 2_000_000
# Second and third bytes of the checked characters outside ASCII (C2 and E2 80: punctuation; C3: Latin letters but for two signs).
C2_SIGNS = [*range(0xA1, 0xAA), *range(0xAB, 0xB2), 0xB4, 0xB6, 0xB7, 0xB8, 0xBB, 0xBF]
E280_SIGNS = [0x93, 0x94, 0x98, 0x99, 0x9C, 0x9D, 0xA6]
C3_SIGNS = [0x97, 0xB7]
_LETTER, _DIGIT, _OTHER, _SPACE, _BAD = 1, 2, 3, 4, 5


def _byte_classes() -> np.ndarray:
    out = np.full(256, _BAD, np.uint8)
    for c in range(33, 127):
        out[c] = _LETTER if chr(c).isalpha() else _DIGIT if chr(c).isdigit() else _OTHER
    out[[9, 10, 13, 32]] = _SPACE
    return out


_CLASSES = _byte_classes()
_C2, _E280, _C3 = (np.isin(np.arange(256), x) for x in (C2_SIGNS, E280_SIGNS, C3_SIGNS))


def classes(data: np.ndarray) -> np.ndarray:
    """The class of each byte; the bytes of a character share it; _BAD for characters outside the checked set."""
    out = _CLASSES[data]
    high = np.flatnonzero(data >= 0xC0)
    if len(high):
        padded = np.concatenate([data, np.zeros(2, np.uint8)])
        lead, second, third = data[high], padded[high + 1], padded[high + 2]
        kind = np.full(len(high), _BAD, np.uint8)
        kind[(lead == 0xC2) & _C2[second]] = _OTHER
        latin = lead == 0xC3
        kind[latin] = np.where(_C3[second[latin]], _OTHER, _LETTER)
        three = (lead == 0xE2) & (second == 0x80) & _E280[third]
        kind[three] = _OTHER
        out[high] = kind
        out[high[(lead == 0xC2) | latin] + 1] = kind[(lead == 0xC2) | latin]
        out[high[three] + 1] = out[high[three] + 2] = _OTHER
    return out


def word_starts(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """First bytes of all words of rows in the checked set, by the byte-level rule."""
    n = len(data)
    first = np.zeros(n + 1, bool)
    first[offsets[:-1]] = True
    first = first[:n]
    lasts = offsets[1:][np.diff(offsets) > 0] - 1
    space = kind == _SPACE
    before_space = np.concatenate([[False], space[:-1]]) & ~first
    after_plain = np.concatenate([~space[1:], [False]])
    after_plain[lasts] = False
    changed = np.concatenate([[True], kind[1:] != kind[:-1]]) | first
    blank = np.concatenate([[False], data[:-1] == 32]) & ~first
    starts = np.where(space, first | ~before_space | after_plain, changed & ~blank)
    # contractions: an apostrophe that starts a word, with the letters that belong to it
    at = np.flatnonzero((data == 39) & starts)
    if len(at):
        end = offsets[np.searchsorted(offsets, at, side="right")]
        get = lambda k: np.where(at + k < end, data[np.minimum(at + k, n - 1)], 0)
        one, two = get(1), get(2)
        size = np.where(np.isin(one, np.frombuffer(b"stmd", np.uint8)), 1, 0)
        size[((one == 114) | (one == 118)) & (two == 101) | (one == 108) & (two == 108)] = 2
        at, end, size = at[size > 0], end[size > 0], size[size > 0]
        starts[at + 1] = False
        rest = at + 1 + size
        rest = rest[(rest < end) & (kind[np.minimum(rest, n - 1)] == _LETTER)]
        starts[rest] = True
    return np.flatnonzero(starts)


def _room(array: np.ndarray, used: int, wanted: int) -> np.ndarray:
    """``array`` with at least ``wanted`` places, the first ``used`` kept."""
    return array if wanted <= len(array) else np.concatenate([array[:used], np.zeros(2 * wanted - used, array.dtype)])


class _Table:
    """Ids and bytes of words by hash: a sorted table of up to ``most`` words."""

    def __init__(self, kind: np.dtype, most: int):
        self.most, self.kind = most, kind
        self.clear()

    def clear(self) -> None:
        self.keys, self.start, self.size = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.begin, self.length = np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.ids, self.used = np.zeros(1 << 16, self.kind), 0
        self.letters, self.filled = np.zeros(1 << 16, np.uint8), 0

    def missing(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.ones(len(keys), bool)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return self.keys[at] != keys

    def add(self, keys: np.ndarray, words: list[bytes], found: list[list[int]]) -> None:
        """``keys`` are sorted and new."""
        size = np.fromiter(map(len, found), np.int32, len(found))
        start = self.used + np.cumsum(size, dtype=np.int64) - size
        used = self.used + int(size.sum())
        self.ids = _room(self.ids, self.used, used)
        self.ids[self.used : used] = [i for ids in found for i in ids]
        self.used = used
        length = np.fromiter(map(len, words), np.int32, len(words))
        begin = self.filled + np.cumsum(length, dtype=np.int64) - length
        filled = self.filled + int(length.sum())
        self.letters = _room(self.letters, self.filled, filled + 8)
        self.letters[self.filled : filled] = np.frombuffer(b"".join(words), np.uint8)
        self.filled = filled
        at = np.searchsorted(self.keys, keys)
        self.keys, self.start, self.size, self.begin, self.length = (np.insert(a, at, x) for a, x in ((self.keys, keys), (self.start, start), (self.size, size), (self.begin, begin), (self.length, length)))

    def spans(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.keys, keys)
        return self.start[at], self.size[at].astype(np.int64)

    def holds(self, keys: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Whether the word under each key is ``data[start:end]``."""
        at = np.searchsorted(self.keys, keys)
        low = self.begin[at]
        return same_words(data, starts, ends, self.letters, low, low + self.length[at], roomy=True)


class ByteEncoder:
    """Ids of the rows of an Arrow text column, as the library's encode with add_special_tokens=False."""

    def __init__(self, path: str, cached_words: int = CACHED_WORDS):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        spec = json.load(open(path, encoding="utf-8"))
        rule = spec["pre_tokenizer"]
        self._known = spec["normalizer"] is None and rule["type"] == "ByteLevel" and not rule["add_prefix_space"] and rule["use_regex"]
        self._special = [a["content"].encode() for a in spec["added_tokens"]]
        self.kind = np.dtype("<u2") if self.tokenizer.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        self._table = _Table(self.kind, cached_words)

    def _whole(self, text: bytes) -> np.ndarray:
        return np.array(self.tokenizer.encode(text.decode(), add_special_tokens=False).ids, self.kind)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all rows after one another, and each row's count."""
        ids, counts, row, rows = [], np.zeros(len(offsets) - 1, np.int64), 0, len(offsets) - 1
        while row < rows:
            end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + SLICE_BYTES, side="right")) - 1)
            part, local = data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
            found, n = self._slice(part, local) if len(part) <= SLICE_BYTES and self._known else self._library(part, local)
            ids.append(found)
            counts[row:end] = n
            row = end
        return (np.concatenate(ids) if ids else np.zeros(0, self.kind)), counts

    def _library(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        found = [self._whole(data[a:b].tobytes()) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        return np.concatenate([np.zeros(0, self.kind), *found]), np.array([len(f) for f in found], np.int64)

    def _slice(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rows = len(offsets) - 1
        if not len(data):
            return np.zeros(0, self.kind), np.zeros(rows, np.int64)
        kind = classes(data)
        odd = np.zeros(rows, bool)
        odd[np.searchsorted(offsets, np.flatnonzero(kind == _BAD), side="right") - 1] = True
        raw = data.tobytes()
        if any(s in raw for s in self._special):
            odd |= np.array([any(s in raw[a:b] for s in self._special) for a, b in zip(offsets[:-1], offsets[1:], strict=True)])
        starts = word_starts(data, offsets, kind)
        ends = np.append(starts[1:], len(data))
        if odd.any():  # no words of rows that the library takes as a whole
            keep = ~odd[np.searchsorted(offsets, starts, side="right") - 1]
            starts, ends = starts[keep], ends[keep]
        keys, first, which = np.unique(hashed(data, starts, ends), return_index=True, return_inverse=True)
        if len(self._table.keys) > self._table.most:
            self._table.clear()
        new = np.flatnonzero(self._table.missing(keys))
        at, end = starts[first], ends[first]
        if len(new):
            words = [raw[a:b] for a, b in zip(at[new].tolist(), end[new].tolist(), strict=True)]
            self._table.add(keys[new], words, [e.ids for e in self.tokenizer.encode_batch_fast([w.decode() for w in words], add_special_tokens=False)])
        other = ~same_words(data, starts, ends, data, at[which], end[which])
        other |= ~self._table.holds(keys, data, at, end)[which]
        if other.any():
            odd[np.searchsorted(offsets, starts[other], side="right") - 1] = True
        start, size = self._table.spans(keys)
        start, size = start[which], size[which]
        before = np.concatenate([[0], np.cumsum(size)])
        ids = self._table.ids[np.repeat(start - before[:-1], size) + np.arange(int(before[-1]))]
        cuts = before[np.searchsorted(starts, offsets)]
        if not odd.any():
            return ids, np.diff(cuts)
        parts = [self._whole(raw[offsets[r] : offsets[r + 1]]) if odd[r] else ids[cuts[r] : cuts[r + 1]] for r in range(rows)]
        return np.concatenate(parts), np.array([len(p) for p in parts], np.int64)


@lru_cache(2)
def encoder(path: str) -> ByteEncoder:
    return ByteEncoder(path)
