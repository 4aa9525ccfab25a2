import random
import re

import numpy as np
from test_wordspans import twins

from lodestrata.llm import substring_dedup


def brute(rows, window):
    """Words kept of each row, by looking at every window."""
    split = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    least = {}
    for i, words in split:
        for p in range(len(words) - window + 1):
            key = tuple(words[p : p + window])
            if i is not None:
                least[key] = min(least.get(key, i), i)
    out = []
    for i, words in split:
        gone = set()
        for p in range(len(words) - window + 1):
            key = tuple(words[p : p + window])
            if key in least and (i is None or least[key] < i):
                gone.update(range(p, p + window))
        out.append((i, len(words), len(gone), " ".join(w for k, w in enumerate(words) if k not in gone)))
    return sorted(out, key=str)


def shared_texts(seed=2, n=50):
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefghijklmnopq") + rng.choice("xyz")
    passages = [[word() for _ in range(rng.randint(5, 130))] for _ in range(8)]
    texts = []
    for _ in range(n):
        words = []
        for _ in range(rng.randint(0, 5)):
            words += rng.choice(passages)[rng.randint(0, 3) :] if rng.random() < 0.6 else [word() for _ in range(rng.randint(1, 80))]
        texts.append("".join(w + rng.choice([" ", "\n", "  "]) for w in words))
    return texts


def check(make_docs, rows, window, **more):
    docs = make_docs(rows)
    rows = [r if isinstance(r, tuple) else (i, r) for i, r in enumerate(rows)]
    found = substring_dedup.repeated_spans(docs, window=window, **more).collect()
    assert sorted(((r["doc_id"], r["n_words"], sum(s["end"] - s["start"] for s in r["spans"]), r["kept"]) for r in found), key=str) == brute(rows, window)


def test_against_brute_force(make_docs, odd_texts):
    texts = odd_texts + shared_texts()
    check(make_docs, texts, 50)
    check(make_docs, texts, 50, block_bytes=3000)


def test_other_windows_and_tiny_blocks(make_docs):
    check(make_docs, shared_texts(4, 30), 7, gram=3, block_bytes=200)
    check(make_docs, ["a a a a a a", "a a a a", "a a", "b a a a b"], 3, gram=1, block_bytes=1)


def test_null_and_equal_ids(make_docs):
    text = " ".join(map(str, range(60)))
    check(make_docs, [(None, text), (None, text), (4, text), (4, text), (6, text), (9, None)], 50)


def test_empty_table(make_docs):
    assert substring_dedup.repeated_spans(make_docs([])).count() == 0


def test_factors_are_copies_of_earlier_documents(make_docs):
    texts = shared_texts(8, 60)
    split = [re.findall(r"[^\x20\x09-\x0D]+", t) for t in texts]
    for size in (4 << 20, 2000):
        n = 0
        for r in substring_dedup.repeated_spans(make_docs(texts), window=20, block_bytes=size).collect():
            covered = set()
            for start, end, source, source_start in r["factors"]:
                assert source < r["doc_id"] and end - start >= 20
                assert split[r["doc_id"]][start:end] == split[source][source_start : source_start + end - start]
                covered.update(range(start, end))
                n += 1
            assert covered == {i for a, b in r["spans"] for i in range(a, b)}
            assert all(a[1] < b[0] for a, b in zip(r["spans"], r["spans"][1:]))
        assert n > 20


def test_phrases_with_one_equal_hash_are_told_apart():
    u = lambda x: np.array(x, np.uint64)
    key, check, doc = u([5, 5, 5, 5, 9, 9]), u([1, 2, 1, 2, 3, 3]), np.array([4, 3, 2, 6, 8, 7])
    assert substring_dedup._sources(key, check, doc).tolist() == [2, 1, 2, 1, 5, 5]
    rng = np.random.default_rng(0)
    for _ in range(50):
        key, check, doc = u(rng.integers(0, 4, 30)), u(rng.integers(0, 3, 30)), rng.integers(0, 9, 30)
        for i, s in enumerate(substring_dedup._sources(key, check, doc).tolist()):
            same = [j for j in range(30) if key[j] == key[i] and check[j] == check[i]]
            assert s == min(same, key=lambda j: (doc[j], j))


def test_windows_that_differ_in_words_of_equal_sums_of_powers(make_docs):
    a, b = twins(2048)
    shared = [str(i) for i in range(60)]
    check(make_docs, [" ".join([*shared[:30], a, *shared[30:]]), " ".join([*shared[:30], b, *shared[30:]])], 50)
    check(make_docs, [" ".join([*shared[:30], a, *shared[30:]])] * 2, 50)


def test_slim_numbers():
    rng = np.random.default_rng(0)
    for values in (np.zeros(0, np.int64), np.array([-1]), rng.integers(-(2**62), 2**62, 1000), np.array([np.iinfo(np.int64).max, 0, -1])):
        assert (substring_dedup._full(substring_dedup._slim(values)) == values).all()


def test_extra_columns_and_repeated_rows(make_docs):
    text = " ".join(map(str, range(70)))
    found = substring_dedup.repeated_spans(make_docs([(1, text), (2, text), (2, text)])).collect()
    assert sorted((r["doc_id"], r["kept"] == "") for r in found) == [(1, False), (2, True), (2, True)]
