import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

import corpus_pipeline
from lodestrata.llm import near_copies


def grams(text, k=near_copies.SHINGLE):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
    return {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def brute_groups(texts):
    """The group of each text: linked if the Jaccard similarity of the shingles is 0.8 or more."""
    sets, root = [grams(t) for t in texts], list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a == b or 5 * len(a & b) >= 4 * len(a | b):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return [find(i) for i in range(len(texts))]


def edited_texts(n=40, seed=4):
    """Texts with copies of 1 to 5 changed words out of 80 to 200: similarities from 0.5 to 0.97."""
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        words = [f"w{rng.randrange(500)}" for _ in range(rng.randint(80, 200))]
        out.append(" ".join(words))
        for _ in range(rng.randint(1, 4)):
            copy = list(words)
            for at in rng.sample(range(len(copy)), rng.randint(1, 5)):
                copy[at] = f"new{rng.randrange(10**6)}"
            out.append(" ".join(copy))
    return out


def stage(spark, docs):
    return corpus_pipeline.drop_near_copies(spark, docs, "")


def test_shingles_and_keys():
    texts = ["a b c d e f", "A  b\nc d e f", "a b c", "", None]
    found = near_copies.shingle_sets(pa.array(texts))
    assert [len(g) for _, g in found] == [len(grams(t)) for t in texts] and found[0][0] == found[1][0] and found[3][0] == found[4][0]
    assert np.array_equal(near_copies.band_keys(found[0][1]), near_copies.band_keys(found[1][1])) and not len(near_copies.band_keys(found[3][1]))


def test_stage_keeps_one_of_each_group(spark, make_docs):
    texts = [None, "", " ", "one", "One", "a b c", *edited_texts()]
    groups = brute_groups(texts)
    assert len(set(groups)) < len(texts) - 40
    assert sorted(r["doc_id"] for r in stage(spark, make_docs(texts)).collect()) == sorted(set(groups))


def test_members_without_a_link_to_the_drawn_one_meet(spark, make_docs):
    rng = random.Random(9)
    words = [f"w{i}" for i in range(120)]
    texts = []
    for _ in range(60):  # around one text, most pairs near 0.8
        copy = list(words)
        for at in rng.sample(range(len(copy)), rng.randint(1, 4)):
            copy[at] = f"new{rng.randrange(10**6)}"
        texts.append(" ".join(copy))
    found = near_copies.near_copies(make_docs(texts).withColumn("row", F.xxhash64("text")), "row").collect()
    component = {r["row"]: r["component"] for r in found}
    assert len(set(component.values())) == len(set(brute_groups(texts)))


def test_a_shared_id_links_nothing(spark, make_docs):
    rng = random.Random(2)
    one, two, three = (" ".join(f"w{rng.randrange(10**6)}" for _ in range(60)) for _ in range(3))
    rows = [(1, one), (5, one), (5, two), (5, two), (7, two), (7, three), (9, three), (9, three + " end")]
    found = sorted((r["doc_id"], r["text"]) for r in stage(spark, make_docs(rows)).collect())
    assert found == sorted([(1, one), (5, two), (7, three)])


def around_one_text(n, seed, most=6):
    rng = random.Random(seed)
    words, out = [f"w{i}" for i in range(120)], []
    for _ in range(n):
        copy = list(words)
        for at in rng.sample(range(len(copy)), rng.randint(1, most)):
            copy[at] = f"new{rng.randrange(10**6)}"
        out.append(" ".join(copy))
    return out


def test_forest_joins_what_links_join_and_no_more():
    for seed in range(6):
        texts = around_one_text(80, seed) + edited_texts(6, seed)
        sets = [g for _, g in near_copies.shingle_sets(pa.array(texts))]
        rng = np.random.default_rng(seed)
        for components in (np.arange(len(texts)), rng.integers(0, 40, len(texts))):
            root = list(range(len(texts)))

            def find(x, root=root):
                while root[x] != x:
                    x = root[x]
                return x

            def join(a, b, root=root, find=find):
                root[find(a)] = find(b)

            for i in range(len(texts)):
                join(i, int(np.flatnonzero(components == components[i])[0]))
            links = near_copies.forest(np.arange(len(texts)), components, sets)
            before = len({find(i) for i in range(len(texts))})
            for a, b in links:
                assert 9 * len(np.intersect1d(sets[a], sets[b])) >= 4 * (len(sets[a]) + len(sets[b]))
                join(a, b)
            after = len({find(i) for i in range(len(texts))})
            assert len(links) == before - after  # a forest
            for i in range(len(texts)):
                for j in range(i):
                    if 9 * len(np.intersect1d(sets[i], sets[j])) >= 4 * (len(sets[i]) + len(sets[j])):
                        assert find(i) == find(j)
    assert near_copies.forest(np.zeros(0, np.int64), np.zeros(0, np.int64), []) == []


def test_hot_keys_in_chunks(spark, make_docs):
    texts = around_one_text(150, 3)
    docs = make_docs(texts).withColumn("row", F.xxhash64("text"))
    for size in (near_copies.GROUP_BYTES, 20_000):
        component = {r["row"]: r["component"] for r in near_copies.near_copies(docs, "row", group_bytes=size).collect()}
        assert len(set(component.values())) == len(set(brute_groups(texts)))
