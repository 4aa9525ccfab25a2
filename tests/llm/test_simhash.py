import random
import re

import xxhash
from pyspark.sql import functions as F

from lodestrata.llm import simhash
from lodestrata.llm.components import connected_components


def brute_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    grams = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(prints, distance=4):
    root = {i: i for i in prints}
    ids = sorted(prints)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, i in enumerate(ids):
        for j in ids[:n]:
            if (prints[i] ^ prints[j]).bit_count() <= distance:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: find(i) for i in ids}


def near_texts(n=60):
    rng = random.Random(3)
    out = []
    for _ in range(n):
        words = [rng.choice("abcdefghij") * rng.randint(1, 3) for _ in range(rng.randint(1, 150))]
        out.append(" ".join(words))
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(len(words))] = "changed"
            out.append(" ".join(words))
    return out


def test_against_brute_force(make_docs, odd_texts):
    texts = odd_texts + near_texts()
    found = {r[0]: (int(r[1]), r[2]) for r in simhash.near_duplicates(make_docs(texts)).collect()}
    prints = {i: brute_print(t) for i, t in enumerate(texts)}
    assert {i: p for i, (p, _) in found.items()} == {i: p - (1 << 64) if p >> 63 else p for i, p in prints.items()}
    assert {i: c for i, (_, c) in found.items()} == brute_components(prints)


def test_dense_and_hot_groups(spark):
    rng = random.Random(1)
    prints = set()
    for centre in (0, (1 << 63) | 12345, rng.getrandbits(64)):
        for _ in range(150):
            p = centre
            for b in rng.sample(range(64), rng.randint(0, 4)):
                p ^= 1 << b
            prints.add(p)
    prints |= {rng.getrandbits(64) for _ in range(200)}
    prints = dict(enumerate(sorted(prints)))
    table = spark.createDataFrame([(i, p - (1 << 64) if p >> 63 else p) for i, p in prints.items()], "id long, fingerprint long")
    expected = brute_components(prints)
    for group_rows in (20_000, 16):
        linked = {r[0]: r[1] for r in connected_components(simhash.near_links(table, group_rows=group_rows)).collect()}
        assert {i: linked.get(i, i) for i in prints} == expected


def test_null_ids_repeats_and_empty(make_docs):
    rows = [(None, "a b"), (5, "a b"), (5, "c d e f g"), (9, "c d e f g"), (3, None), (None, None)]
    found = sorted(tuple(r)[::2] for r in simhash.near_duplicates(make_docs(rows)).collect() if r[0] is not None)
    assert found == [(3, 3), (5, 5), (5, 5), (9, 5)]
    assert simhash.near_duplicates(make_docs([])).count() == 0


def test_masks_cover_all_close_pairs():
    rng = random.Random(5)
    for rows in (10, 10**5, 10**8, 10**12):
        masks = simhash.block_masks(rows, 4)
        for _ in range(300):
            flips = sum(1 << b for b in rng.sample(range(64), 4))
            assert any(not flips & m for m in masks)


def test_long_chain_of_components(spark):
    edges = spark.range(200).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert {tuple(r) for r in connected_components(edges).collect()} == {(i, 0) for i in range(201)}
