import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from lodestrata.llm import queries
from lodestrata.llm import shuffle_shards as sh


def test_fisher_yates_is_fair_and_seeded():
    counts = Counter(tuple(sh.fisher_yates(3, (i,)).tolist()) for i in range(6000))
    assert len(counts) == 6 and min(counts.values()) > 850
    assert (sh.fisher_yates(50, (1, 2)) == sh.fisher_yates(50, (1, 2))).all() and sh.fisher_yates(0, (1,)).tolist() == []


def test_buckets_follow_whole_records(spark, tmp_path):
    docs = spark.createDataFrame([(7, "same", f"wide column {i} " * 200, {"k": i}) for i in range(200)], "doc_id long, text string, `other.one` string, place map<string,int>")
    sh.write_shards(docs, f"{tmp_path}/w", shards=2, bucket_bytes=100_000)
    read = sh.read_shards(spark, f"{tmp_path}/w")
    sizes = [r["count"] for r in read.groupBy("shard", "bucket").count().collect()]
    assert sum(sizes) == 200 and len(sizes) >= 5 and max(sizes) < 80
    assert sorted(r["p"] for r in read.select(F.col("record")["place"]["k"].alias("p")).collect()) == list(range(200))


def brute_shards(rows, shards=24, seed=sh.SEED, spark=None):
    """(id, shard) by the highest ticket, from Spark's hash of plain literals."""
    tickets = spark.createDataFrame([(i, s) for i, _ in rows for s in range(shards)], "id long, s int").selectExpr("id", "s", f"xxhash64(id, s, {seed}) AS ticket").collect()
    best = {}
    for r in tickets:
        best[r["id"]] = max(best.get(r["id"], (-(2**63), -1)), (r["ticket"], r["s"]))
    return {i: s for i, (_, s) in best.items()}


def test_query_equals_brute_force(spark, make_docs, tmp_path):
    """Shards, the grown shard, and the order within each shard, computed again record by record."""
    rows = [(i, f"text {i} " * (i % 40)) for i in range(400)]
    make_docs(rows).write.parquet(f"{tmp_path}/documents.parquet")
    found = {r["doc_id"]: r for r in queries.op9_shuffle_shards(spark, str(tmp_path)).collect()}
    small, grown = (brute_shards(rows, n, spark=spark) for n in (24, 25))
    assert {i: (r["shard"], r["grown_shard"]) for i, r in found.items()} == {i: (small[i], grown[i]) for i in found}
    ties = {r["doc_id"]: (r["tie"], r["tie2"]) for r in make_docs(rows).selectExpr("doc_id", "xxhash64(doc_id, text, lang, source, n_chars, spans, id, fingerprint) AS tie", f"xxhash64({sh.SEED}, doc_id, text, lang, source, n_chars, spans, id, fingerprint) AS tie2").collect()}
    for shard in range(24):  # one bucket each, as the texts are few
        own = sorted((i for i in small if small[i] == shard), key=ties.get)
        draws = np.random.default_rng((sh.SEED, shard, 0)).integers(0, np.arange(1, max(len(own), 1) + 1)).tolist()
        for i in range(len(own) - 1, 0, -1):
            own[i], own[draws[i]] = own[draws[i]], own[i]
        assert [i for i, _ in sorted(((i, found[i]["slot"]) for i in own), key=lambda x: x[1])] == own


def test_query(spark, make_docs, odd_texts, tmp_path):
    texts = odd_texts * 8
    make_docs(texts).write.parquet(f"{tmp_path}/documents.parquet")
    rows = queries.op9_shuffle_shards(spark, str(tmp_path)).collect()
    assert sorted(r["doc_id"] for r in rows) == list(range(len(texts)))
    for r in rows:
        raw = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"]) == (len(raw) + 8, zlib.crc32(raw), "key")
        assert r["grown_shard"] in (r["shard"], 24) and 0 <= r["shard"] < 24
    assert any(r["grown_shard"] == 24 for r in rows)
    by = {}
    for r in rows:
        by.setdefault(r["shard"], []).append(r)
    assert len(by) == 24
    for own in by.values():
        assert sorted(r["slot"] for r in own) == list(range(len(own)))
    assert any([r["doc_id"] for r in sorted(own, key=lambda r: r["slot"])] != sorted(r["doc_id"] for r in own) for own in by.values())


def test_small_buckets_whole_records_nulls_and_repeats(spark, make_docs, tmp_path):
    rows = [(None, "a"), (None, None), (3, "x"), (3, "x"), (3, "y"), *((i, "t" * i) for i in range(10, 60))]
    docs = make_docs(rows)
    for at, most in (("a", 1), ("b", 200), ("c", 1 << 20)):
        sh.write_shards(docs, f"{tmp_path}/{at}", shards=3, bucket_bytes=most)
        read = sh.read_shards(spark, f"{tmp_path}/{at}")
        assert sorted(map(str, read.select("record.*").collect())) == sorted(map(str, docs.collect()))
        found = sh.slots(read, read["record"]["doc_id"].alias("doc_id")).collect()
        assert len({r["shard"] for r in found if r["doc_id"] == 3}) == 1
        for s in range(3):
            slots = sorted(r["slot"] for r in found if r["shard"] == s)
            assert slots == list(range(len(slots)))
    schema = sh.write_shards(make_docs([]), f"{tmp_path}/e", shards=3)
    assert sh.slots(sh.read_shards(spark, f"{tmp_path}/e", schema), F.col("record.doc_id")).count() == 0


def test_result_does_not_depend_on_partitions(spark, make_docs, tmp_path):
    docs = make_docs([f"text {i}" for i in range(100)])
    found = []
    for n in (1, 7):
        sh.write_shards(docs.repartition(n), f"{tmp_path}/{n}", shards=4, bucket_bytes=100)
        read = sh.read_shards(spark, f"{tmp_path}/{n}")
        found.append(sorted(map(tuple, sh.slots(read, read["record"]["doc_id"].alias("doc_id")).collect())))
    assert found[0] == found[1]
