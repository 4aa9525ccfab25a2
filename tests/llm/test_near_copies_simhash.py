import random

import numpy as np
from pyspark.sql import functions as F
from test_near_copies import around_one_text, brute_groups, grams

from lodestrata.llm import near_copies


def drawn(rng, n):
    return rng.integers(0, 1 << 63, n, dtype=np.uint64)


def test_bits_are_majorities():
    rng = np.random.default_rng(1)
    for n in (1, 2, 7, 255, 256, 600):
        own = drawn(rng, n)
        hashes = [[int(h) for h in near_copies.mix(own * f)] for f in near_copies._factors(3)]
        expected = [int(2 * sum(h >> b & 1 for h in hashes[w]) > n) for w in range(3) for b in range(64)]
        assert near_copies.simhash_bits(own, 150).tolist() == expected[:150]


def test_pairs_of_similarity_0_8_agree_on_a_block_and_nearly_in_the_rest():
    rng = np.random.default_rng(2)
    for common, a, b in ((4, 0, 1), (12, 1, 2), (40, 5, 5), (400, 50, 50), (400, 0, 100)):
        missed = 0
        for _ in range(200):
            x = drawn(rng, common + a + b)
            one, two = (near_copies.fingerprint(s, 8) for s in (x[: common + a], np.concatenate([x[:common], x[common + a :]])))
            near = sum(int(p ^ q).bit_count() for p, q in zip(one[0], two[0], strict=True)) <= near_copies.FAR
            missed += not (near and len(np.intersect1d(one[1], two[1])))
        assert missed <= 2


def test_members_of_a_key_are_near_in_small_and_large_keys(spark):
    rng = np.random.default_rng(3)
    base = [drawn(rng, 1)[0] for _ in range(40)]
    rows = [(i, int(base[i % 40] >> np.uint64(1)) ^ (1 << i % 50), 7, [5, 100 + i % 2]) for i in range(300)]
    frame = spark.createDataFrame(rows, "node long, low long, high long, hashes array<long>")
    for most in (20_000, 60):
        found = {}
        for r in near_copies.near_members(frame, most).collect():
            found.setdefault(r["key"], set()).add(r["node"])
        together = {frozenset((a, b)) for own in found.values() for a in own for b in own if a != b}
        assert all(a % 40 == b % 40 or any((rows[a][1] ^ r[1]).bit_count() <= near_copies.FAR for r in rows if r[0] != a) for a, b in map(tuple, together))
        assert {frozenset((a, b)) for a in range(300) for b in range(a) if (rows[a][1] ^ rows[b][1]).bit_count() <= near_copies.FAR} <= together


def test_short_texts_and_small_chunks_of_fingerprints(spark, make_docs, monkeypatch):
    monkeypatch.setattr(near_copies.near_members, "__defaults__", (50,))
    rng = random.Random(6)
    texts = around_one_text(120, 8)
    for _ in range(40):
        words = [f"s{rng.randrange(10**6)}" for _ in range(8)]
        texts += [" ".join(words), " ".join([*words, "end"])]  # 4 of 5 shingles
    assert all(len(grams(t)) in (4, 5) for t in texts[120:])
    docs = make_docs(texts).withColumn("row", F.xxhash64("text"))
    component = {r["row"]: r["component"] for r in near_copies.near_copies(docs, "row").collect()}
    assert len(set(component.values())) == len(set(brute_groups(texts)))


def test_a_group_of_near_copies_has_a_row_a_member_and_is_dealt_out_in_proportion(spark):
    rng = np.random.default_rng(7)
    base = int(drawn(rng, 1)[0] >> np.uint64(1))
    for n in (100, 200):
        rows = [(i, base ^ (1 << i % 60), i // 60, list(range(40)), 50) for i in range(n)]
        frame = spark.createDataFrame(rows, "node long, low long, high long, hashes array<long>, size int")
        for most in (20_000, 20):
            found = near_copies.near_members(frame, most).collect()
            assert sorted(r["node"] for r in found) == list(range(n)) and len({r["key"] for r in found}) == 1
    far = spark.createDataFrame([(1, 5, 5, [9], 100), (2, 5, 5, [9], 79), (3, 5, 5, [9], 80)], "node long, low long, high long, hashes array<long>, size int")
    assert {r["key"] for r in near_copies.near_members(far).collect()} == {1}  # 79 and 80, 80 and 100

    for n in (1_000, 2_000):  # of one key, all but 10 linked with the drawn one
        rows = spark.range(n).select(F.lit(1).alias("key"), F.col("id").alias("node"), (F.col("id") >= 10).alias("main"))
        parts = spark.createDataFrame([(1, n // 100, 2)], "key int, n_main long, n_rest long")
        dealt = near_copies.dealt_out(rows, parts).collect()
        assert len(dealt) <= 2 * n + 10 * (n // 100 + 1)
        at = {}
        for r in dealt:
            at.setdefault(r["node"], set()).add(r["chunks"])
        assert all(at[i] & at[j] for i in range(10) for j in range(n))
