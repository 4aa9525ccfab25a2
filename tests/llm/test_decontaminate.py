import random
import re

import numpy as np
import pyarrow as pa

from lodestrata.llm import decontaminate as d
from lodestrata.llm import queries


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D!-/:-@\[-`{-~]+", "".join(c.lower() if c.isascii() else c for c in text or ""))


def brute_share(doc, item, seed):
    """Covered words of the item: the longest free match first, all pairs of positions tried."""
    in_doc, in_item = [False] * len(doc), [False] * len(item)
    while True:
        best = (0, 0, 0)
        for b in range(len(item)):
            for a in range(len(doc)):
                n = 0
                while a + n < len(doc) and b + n < len(item) and doc[a + n] == item[b + n] and not in_doc[a + n] and not in_item[b + n]:
                    n += 1
                if n > best[0]:
                    best = (n, a, b)
        n, a, b = best
        if n < seed:
            return sum(in_item) / len(item)
        in_doc[a : a + n] = in_item[b : b + n] = [True] * n


def cases(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abc") for _ in range(rng.randint(1, 2)))
    items = [[word() for _ in range(rng.randint(1, 25))] for _ in range(12)]
    docs = []
    for _ in range(25):
        words = [word() for _ in range(rng.randint(0, 30))]
        for item in rng.sample(items, rng.randint(0, 2)):
            cut = rng.randint(0, len(item))
            at = rng.randint(0, len(words))
            words[at:at] = item[cut:] + [word()] * rng.randint(0, 2) + item[:cut]
        docs.append("".join(w.upper() + rng.choice([" ", ", ", "\n", ". "]) if rng.random() < 0.2 else w + " " for w in words))
    return docs, [" ".join(i) for i in items]


def brute(docs, items, seed=5, coverage=0.6):
    found = set()
    for r, doc in enumerate(docs):
        for t, item in enumerate(items):
            a, b = words_of(doc), words_of(item)
            if b and brute_share(a, b, min(seed, len(b))) >= coverage:
                found.add((r, t))
    return found


def test_tiles_match_brute_force():
    for seed in range(4):
        docs, items = cases(seed)
        index = d.Index.of(list(range(len(items))), items, 5)
        found = {(r, t): s for r, t, s, _ in d._found(pa.array(docs), index, 0.6)}
        assert set(found) == brute(docs, items)
        for (r, t), share in found.items():
            assert abs(share - brute_share(words_of(docs[r]), words_of(items[t]), min(5, len(words_of(items[t]))))) < 0.25  # equally long tiles may be marked in another order


def test_reordered_passages_and_clean_documents(spark, make_docs, odd_texts):
    item = " ".join(f"w{i}" for i in range(40))
    half = item.split()
    swapped = "x y z " + " ".join(half[20:]) + " and then " + " ".join(half[:20]) + " end"
    few = " ".join(half[:20])
    texts = [swapped, few, item.upper().replace(" ", ", "), None, *odd_texts]
    bench = spark.createDataFrame([(5, item), (6, None), (7, ""), (8, "w1 w2"), (5, item)], "item_id long, text string")
    docs = make_docs(texts)
    for block_bytes in (d.BLOCK_BYTES, 10):
        hits = {r["doc_id"]: [h["item"] for h in r["hits"]] for r in d.benchmark_hits(docs, bench, block_bytes=block_bytes).collect()}
        assert {i: sorted(h) for i, h in hits.items() if h} == {0: [5, 5, 8], 1: [8], 2: [5, 5, 8]}
        kept = d.decontaminated(docs, bench, block_bytes=block_bytes)
        assert kept.columns == docs.columns
        assert sorted(r["doc_id"] for r in kept.collect()) == [*range(3, len(texts))]


def test_query_and_empty_tables(spark, make_docs, tmp_path):
    docs, items = cases(9)
    make_docs(docs).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = queries.op5_decontaminate(spark, str(tmp_path)).collect()
    assert {(r["doc_id"], int(i)) for r in rows for i in r["items"].split(",") if i} == brute(docs, items) and len(rows) == len(docs)
    none = spark.createDataFrame([], "item_id long, text string")
    assert d.benchmark_hits(make_docs(docs), none).where("size(hits) > 0").count() == 0
    assert d.benchmark_hits(make_docs([]), spark.createDataFrame([(1, items[0])], "item_id long, text string")).count() == 0
    assert d.decontaminated(make_docs(docs), none).count() == len(docs)


def test_repetitive_text_is_quick():
    index = d.Index.of([1], ["a " * 60], 5)
    (found,) = d._found(pa.array(["a " * 20_000]), index, 0.6)
    assert found[2] == 1.0 and np.array(found[3]).tolist()[0][2] == 60


def test_short_items(spark, make_docs):
    docs = make_docs(["What is the CAPITAL, of France?", "of the capital is what", "France", None, "", "paris paris"])
    bench = spark.createDataFrame([(1, "the capital of france"), (2, "paris"), (3, "..."), (4, "what is the")], "item_id long, text string")
    for size in (d.BLOCK_BYTES, 8):
        hits = {r["doc_id"]: sorted((h["item"], h["coverage"]) for h in r["hits"]) for r in d.benchmark_hits(docs, bench, block_bytes=size).collect()}
        assert hits == {0: [(1, 1.0), (4, 1.0)], 1: [], 2: [], 3: [], 4: [], 5: [(2, 1.0)]}


def test_both_ways_of_tiling_agree():
    rng = np.random.default_rng(0)
    for _ in range(300):
        doc, item = (d.word_hashes(*d.utf8(pa.array([" ".join(rng.choice(list("ab"), n))])))[0] for n in (rng.integers(1, 60), rng.integers(1, 30)))
        grams = [d.gram_hashes(x, 3) for x in (doc, item)]
        pairs = [(i, j) for i, g in enumerate(grams[0]) for j, h in enumerate(grams[1]) if g == h]
        i, j = np.array(pairs, np.int64).reshape(-1, 2).T
        assert (d.tiles(doc, item, i, j, 3) if len(i) else []) == d.tiles_by_length(doc, item, 3)


def test_ten_thousand_items_of_one_opening_phrase():
    opening = "what is the answer to this question please tell"
    items = [f"{opening} w{i} x{i} y{i} z{i} v{i} u{i} t{i} s{i} r{i} q{i} p{i} o{i}" for i in range(10_000)]
    index = d.Index.of(list(range(10_000)), items, 5)
    texts = [f"{opening} . " * 3000, f"so {items[77]} end", f"{opening} " * 2000 + items[5]]
    assert [(r, t) for r, t, *_ in d._found(pa.array(texts), index, 0.6)] == [(1, 77), (2, 5)]


def test_text_and_item_of_one_word():
    index = d.Index.of([1], ["a " * 3000], 5)
    ((_, _, share, marked),) = d._found(pa.array(["a " * 20_000]), index, 0.6)  # 60 million pairs of seeds
    assert share == 1.0 and marked == [(0, 0, 3000)]


def test_columns_with_dots_and_clashing_names(spark):
    bench = spark.createDataFrame([(1, "a b c d e f"), (2, "g h i j k l")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "x a b c d e f", 5, 6, 7), (2, "nothing of it", 8, 9, 10)], "doc_id long, text string, `a.b` int, hits int, key long")
    for size in (d.BLOCK_BYTES, 8):
        assert list(map(tuple, d.decontaminated(docs, bench, block_bytes=size).collect())) == [(2, "nothing of it", 8, 9, 10)]
