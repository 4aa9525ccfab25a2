import random
import re
import zlib

import numpy as np
import pyarrow as pa

from lodestrata.llm import queries
from lodestrata.llm import toxicity as t

BAD = ["vile", "scum", "trash", "idiot"]


def corpus(n=900, seed=0):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6))) for _ in range(400)]
    texts, labels = [], []
    for _ in range(n):
        toxic = rng.random() < 0.2
        text = [rng.choice(words) for _ in range(rng.randint(5, 60))]
        for _ in range(2 if toxic else 0):
            text.insert(rng.randint(0, len(text)), rng.choice(BAD) + rng.choice(["", ",", "!"]))
        texts.append(" ".join(text).capitalize())
        labels.append(int(toxic))
    return texts, labels


def test_nearest_equals_brute_force():
    rng = np.random.default_rng(0)
    terms = 40
    for n in (1, 5, 300, 1000):
        vectors = []
        for _ in range(n):
            at = np.sort(rng.choice(terms, rng.integers(1, 6), replace=False))
            w = rng.choice([1.0, 2.0, 3.0], len(at))
            vectors.append((at, w / np.sqrt((w * w).sum())))
        index = t.Examples(vectors, [int(rng.integers(0, 2)) for _ in range(n)], list(range(n)), terms, k=7)
        dense = np.zeros((len(index.n), terms))
        for (at, w), entry in zip(vectors, index.of, strict=True):
            dense[entry, at] = w
        assert index.n.sum() == n
        for at, w in vectors[:60]:
            found, cosine = index.nearest(at, w)
            all_ = np.round(dense[:, at] @ w, t.DIGITS)
            best = sorted((-c, d) for c, d in zip(all_.tolist(), index.doc.tolist(), strict=True) if c > 0)[:7]  # ties too
            assert [(-c, d) for c, d in zip(cosine.tolist(), index.doc[found].tolist(), strict=True)] == best


def test_blocks_that_cannot_win_are_not_read():
    rng = np.random.default_rng(0)
    unit = lambda w: w / np.sqrt((w * w).sum())
    common = [(np.array([0, 1 + i % 500]), unit(np.array([1.0, 3.0 + rng.random()]))) for i in range(20_000)]
    index = t.Examples(common, [0] * 20_000, list(range(20_000)), 501, k=5)
    found, cosine = index.nearest(np.array([0, 7]), unit(np.array([1.0, 9.0])))
    assert set(index.of[6::500][:40]) >= set(found.tolist()) and (cosine > 0.9).all()
    assert index.postings_read < 100  # of 40 with the second term and 20,000 with the first, which has a full row
    rare = [(np.array([i % 400, 400 + i % 97]), unit(np.array([1.0, 1.0 + i % 7]))) for i in range(20_000)]
    index = t.Examples(rare, [0] * 20_000, list(range(20_000)), 497, k=5)
    for query in ([3, 403], [7, 400]):
        index.postings_read, at, w = 0, np.array(query), unit(np.array([1.0, 6.0]))
        cosines = [sum(float(x[list(a).index(u)] * v) for u, v in zip(query, w, strict=True) if u in a) for a, x in rare]
        best = sorted((-round(c, t.DIGITS), i) for i, c in enumerate(cosines))[:5]
        found, cosine = index.nearest(at, w)
        assert [(-c, d) for c, d in zip(cosine.tolist(), index.doc[found].tolist(), strict=True)] == best
        parts = np.concatenate([np.arange(index.cuts[u], index.cuts[u + 1]) for u in query])
        assert index.postings_read < 0.9 * index.part_size[parts].sum()


def test_vectors_equal_a_plain_formula():
    texts = ["the cat, the DOG", "", None, "bird", "cat " * 50, "bird bird cat"]
    words = ["cat", "dog", "the"]
    hashes = {w: int(t.terms_of(pa.array([w]))[1][0]) for w in words}
    order = sorted(words, key=hashes.get)
    weights = {"cat": 1.5, "dog": 2.0, "the": 1.1}
    vocabulary = t.Vocabulary(np.array([hashes[w] for w in order], np.uint64), np.array([weights[w] for w in order]), 3.0)
    for text, (at, weight) in zip(texts, vocabulary.vectors(pa.array(texts, pa.string())), strict=True):
        own = re.findall(r"\w+", (text or "").lower())
        raw = {w: (1 + np.log(own.count(w))) * weights.get(w, 3.0) for w in set(own)}
        norm = np.sqrt(sum(v * v for v in raw.values()))
        assert {order[a]: round(float(w), 9) for a, w in zip(at, weight, strict=True)} == {w: round(v / norm, 9) for w, v in raw.items() if w in weights}


def test_monotone_curve_rises():
    rng = np.random.default_rng(1)
    votes = rng.random(2000)
    x, y = t.monotone(votes, (rng.random(2000) < votes).astype(float))
    assert (np.diff(x) >= 0).all() and (np.diff(y) >= 0).all() and abs(np.interp(0.5, x, y) - 0.5) < 0.15


def test_query_on_held_out_rows(spark, make_docs, tmp_path, odd_texts):
    texts, labels = corpus()
    texts = texts + odd_texts
    make_docs(texts).write.parquet(f"{tmp_path}/documents.parquet")
    rows = [(i, 1, y) for i, y in enumerate(labels)] + [(3, 1, None), (None, 1, 1), (10**9, 0, 1)]
    spark.createDataFrame(rows, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    found = {r["doc_id"]: r for r in queries.op2_toxicity(spark, str(tmp_path)).collect()}
    assert len(found) == len(texts)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) and r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in found.items())
    held = [i for i in range(len(labels)) if found[i]["held_out"]]
    assert sum(found[i]["predicted"] == labels[i] for i in held) / len(held) > 0.97
    toxic = [i for i in held if labels[i]]
    assert sum(found[i]["predicted"] for i in toxic) / len(toxic) > 0.95
    assert any(r["evidence"] for r in found.values())


def test_labels_of_held_out_rows_and_other_columns_change_nothing(spark, make_docs):
    texts, labels = corpus(300)
    docs = make_docs(texts)
    scores = []
    for flip in (False, True):
        rows = [(i, y if zlib.crc32(str(i).encode()) % 5 else y ^ flip) for i, y in enumerate(labels)]
        model = t.fit(docs, t.training_rows(spark.createDataFrame(rows, "doc_id long, toxic int")))
        scores.append(sorted((r["record"]["doc_id"], r["score"]) for r in t.score(docs, model).collect()))
    assert scores[0] == scores[1]


def test_empty_tables(spark, make_docs):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    model = t.fit(make_docs(["a", None]), none)
    assert [r["score"] for r in t.score(make_docs(["a", None]), model).collect()] == [0.0, 0.0]
    assert t.score(make_docs([]), model).count() == 0


def held_out(spark, make_docs, texts, labels):
    """(toxic rows found, toxic rows, other rows marked, other rows) of the rows that nothing was learnt from."""
    docs = make_docs(texts)
    model = t.fit(docs, t.training_rows(spark.createDataFrame(list(enumerate(labels)), "doc_id long, toxic int")))
    found = {r["record"]["doc_id"]: r["score"] >= 0.5 for r in t.score(docs, model, evidence=0).collect()}
    held = [i for i in range(len(labels)) if zlib.crc32(str(i).encode()) % 5 == 0]
    toxic = [i for i in held if labels[i]]
    return sum(found[i] for i in toxic), len(toxic), sum(found[i] for i in held) - sum(found[i] for i in toxic), len(held) - len(toxic)


def test_a_small_label_table_teaches(spark, make_docs):
    clean = [f"plain text{i} about weather{i % 7} and sport{i % 5}" for i in range(30)]
    texts = [f"{x} you vile scum" if i % 4 == 0 else x for i, x in enumerate(clean)]
    model = t.fit(make_docs(texts), t.training_rows(spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(30)], "doc_id long, toxic int")))
    assert len(model.vocabulary.terms)
    docs = make_docs(["you vile scum", "a vile text99 about sport3", "plain text77 about weather1 and sport2"])
    assert [r["score"] >= 0.5 for r in sorted(t.score(docs, model).collect(), key=lambda r: r["record"]["doc_id"])] == [True, True, False]


def test_rare_toxic_words_count(spark, make_docs):
    texts, labels = corpus(900, 3)
    for i in (11, 22, 33):  # three of 900 rows have this word; all are toxic
        texts[i], labels[i] = texts[i] + " grobian", 1
    model = t.fit(make_docs(texts), spark.createDataFrame(list(enumerate(labels)), "doc_id long, toxic int"))
    assert int(t.terms_of(pa.array(["grobian"]))[1][0]) in model.vocabulary.terms.tolist()


def test_any_base_rate(spark, make_docs):
    for rate in (0.1, 0.3, 0.5, 0.8):
        rng = random.Random(0)
        words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6))) for _ in range(400)]
        labels = [int(rng.random() < rate) for _ in range(2400)]
        texts = [" ".join([rng.choice(words) for _ in range(rng.randint(5, 60))] + rng.sample(BAD, 2) * y) for y in labels]
        hits, toxic, false, others = held_out(spark, make_docs, texts, labels)
        assert toxic > 20 and others > 20 and hits >= 0.95 * toxic and false <= 0.03 * others


def brute_scores(texts, rows):
    """Scores by documents, from dictionaries: every cosine with every example, no index."""
    words = [re.findall(r"\w+", (x or "").lower()) for x in texts]
    labels = {}
    for i, y in rows:
        if i is not None and y is not None and i < len(texts) and zlib.crc32(str(i).encode()) % 5:
            labels[i] = max(y, labels.get(i, 0))
    n, toxic = len(labels), sum(labels.values())
    base, known, df = toxic / n, {w for i in labels for w in words[i]}, {}
    for own in words:
        for w in set(own):
            df[w] = df.get(w, 0) + 1
    weight = {}
    for w in known:
        own = [labels[i] for i in labels if w in words[i]]
        odds = (sum(own) + 2 * base) / (len(own) - sum(own) + 2 * (1 - base)) * (1 - base) / base
        weight[w] = (np.log((1 + len(texts)) / (1 + df[w])) + 1) * (1 + np.log(odds) ** 2)
    other = np.log((1 + len(texts)) / 2) + 1

    def vector(own):
        raw = {w: (1 + np.log(own.count(w))) * weight.get(w, other) for w in sorted(set(own))}
        norm = np.sqrt(sum(x * x for x in raw.values()))
        return {w: x / norm for w, x in raw.items() if w in known}

    vectors = [vector(own) for own in words]
    groups = {}
    for i, y in sorted(labels.items()):
        g = groups.setdefault(tuple(sorted((w, words[i].count(w)) for w in set(words[i]))), [vectors[i], i, 0, 0])
        g[2], g[3] = g[2] + 1, g[3] + y
    blank = groups.pop((), [None, None, 0, 0])
    groups = list(groups.values())

    def vote(v, own=None, label=0):
        if not v:
            return (blank[3] - label + base) / (blank[2] - (own is not None) + 1)
        near = sorted((-round(sum(x * g[0].get(w, 0.0) for w, x in v.items()), t.DIGITS), g[1], j) for j, g in enumerate(groups))
        top, total = base, 1.0
        for c, _, j in [x for x in near if x[0] < 0][: t.NEIGHBOURS + (own is not None)]:
            size, bad = groups[j][2] - (j == own), groups[j][3] - (label if j == own else 0)
            if size:
                w = -c / (max(0.0, 1 + c) + t.SOFT) * (1 + np.log(size))
                top, total = top + w * bad / size, total + w
        return top / total

    place = {g[1]: j for j, g in enumerate(groups)}
    of = {i: next((j for j, g in enumerate(groups) if g[0] == vectors[i]), None) for i in labels if i not in place} | place
    ids = sorted(labels)
    votes = np.array([vote(vectors[i], of[i] if of[i] is not None else -1, labels[i]) for i in ids])
    x, y = t.monotone(votes, np.array([labels[i] for i in ids], float), least=min(20, max(1, min(toxic, n - toxic) // 2)))
    return [float(np.clip(np.interp(vote(v), x, y), 0, 1)) if len(x) else vote(v) for v in vectors]


def test_query_equals_brute_force(spark, make_docs, tmp_path):
    texts, labels = corpus(260, 5)
    texts = [*texts, None, "", "  ", "cat cat dog", texts[3], texts[3], texts[8], "unseen words only", "vile"]
    rows = [*enumerate(labels), (260, 0), (261, 0), (264, 1), (265, 1), (266, labels[8]), (3, None), (None, 1), (7, labels[7]), (10**9, 1)]
    make_docs(texts).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, y) for i, y in rows], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    found = {r["doc_id"]: r["score"] for r in queries.op2_toxicity(spark, str(tmp_path)).collect()}
    assert np.allclose([found[i] for i in range(len(texts))], brute_scores(texts, rows), atol=1e-6)


def test_few_labels_and_repeated_ids(spark, make_docs):
    texts, labels = corpus(400, 7)
    docs = make_docs([(i % 380, x) for i, x in enumerate(texts)])  # twenty ids have two texts
    for n in (20, 380):
        model = t.fit(docs, spark.createDataFrame(list(enumerate(labels[:n])), "doc_id long, toxic int"))
        assert len(model.examples.of) == n and model.examples.n.sum() + model.examples.blank[0] == n
        found = t.score(docs, model, evidence=0).collect()
        assert len(found) == 400
    hits = [r["score"] >= 0.5 for r in sorted(found, key=lambda r: texts.index(r["record"]["text"]))]
    assert sum(h == bool(y) for h, y in zip(hits, labels, strict=True)) > 380


def test_the_sample_is_bounded_by_rows_and_bytes(spark, make_docs):
    texts, labels = corpus(300, 9)
    docs, rows = make_docs(texts), spark.createDataFrame(list(enumerate(labels)), "doc_id long, toxic int")
    assert len(t.fit(docs, rows, sample_rows=40).examples.of) == 40
    one = t.fit(docs, rows, sample_bytes=4000).examples
    assert 5 < len(one.of) < 60
    assert len(t.fit(docs, rows, sample_bytes=1).examples.of) == 1
