import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from lodestrata.llm import wordspans as w

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aB é\t\n\x0b\x1c日,.", max_size=60)), max_size=8)


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


@settings(max_examples=200, deadline=None)
@given(TEXTS)
def test_words_and_hashes(texts):
    hashes, rows = w.word_hashes(*w.utf8(pa.array(texts, pa.string())))
    found = {}
    for i, text in enumerate(texts):
        own = hashes[rows[i] : rows[i + 1]].tolist()
        words = split(text)
        assert len(own) == len(words)
        for word, h in zip(words, own, strict=True):
            assert found.setdefault(word, h) == h
    assert len(set(found.values())) == len(found)


def test_slices_change_nothing(monkeypatch):
    texts = ["ab " * 50 + "c" * 500 + " d", "c" * 500, "x", None, "", "ab d " + "c" * 499 + "\n" + "c" * 500, "y" * 64 + " z"]
    monkeypatch.setattr(w, "SLICE_BYTES", 64)
    hashes, rows = w.word_hashes(*w.utf8(pa.array(texts, pa.string())))
    found = {}
    for i, text in enumerate(texts):
        words = split(text)
        assert rows[i + 1] - rows[i] == len(words)
        for word, h in zip(words, hashes[rows[i] : rows[i + 1]].tolist(), strict=True):
            assert found.setdefault(word, h) == h
    assert len(set(found.values())) == len(found)


def twins(n):
    """The two complementary Thue-Morse words over a and b: sums of powers modulo 2**64 can't tell them apart from 1,024 letters on."""
    word = "a"
    while len(word) < n:
        word += word.translate({97: "b", 98: "a"})
    return word, word.translate({97: "b", 98: "a"})


def test_words_with_equal_sums_of_powers():
    for n in (8, 16, 64, 1024, 2048, 4096):
        a, b = twins(n)
        hashes, _ = w.word_hashes(*w.utf8(pa.array([f"{a} {b} {a}"])))
        assert hashes[0] == hashes[2] != hashes[1]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.text(alphabet="ab", max_size=70), st.text(alphabet="ab", max_size=70), st.booleans()), max_size=12))
def test_same_words(pairs):
    pairs = [(a, a if equal else b) for a, b, equal in pairs]
    sides = [[p[i].encode() for p in pairs] for i in (0, 1)]
    ends = [np.cumsum([0, *map(len, x)]) for x in sides]
    data = [np.frombuffer(b"".join(x), np.uint8) for x in sides]
    found = w.same_words(data[0], ends[0][:-1], ends[0][1:], data[1], ends[1][:-1], ends[1][1:])
    assert found.tolist() == [a == b for a, b in zip(*sides, strict=True)]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=40), st.integers(1, 6))
def test_grams_and_minima(values, k):
    words = w.mix(np.array(values, np.uint64) + np.uint64(9))
    grams = w.gram_hashes(words, k)
    keys = [tuple(values[i : i + k]) for i in range(len(values) - k + 1)]
    assert len(grams) == len(keys)
    assert len(set(zip(keys, grams.tolist(), strict=True))) == len(set(keys)) == len(set(grams.tolist()))
    least = w.window_minima(words, k)
    assert least.tolist() == [min(words[i : i + k].tolist()) for i in range(len(words) - k + 1)]


def test_folding():
    a, _ = w.word_hashes(*w.utf8(pa.array(["The CAT, sat.É"])), w.folded_bytes())
    b, _ = w.word_hashes(*w.utf8(pa.array(["the cat sat É"])))
    assert a.tolist() == b.tolist()
