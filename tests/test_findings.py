"""Queries on tables on which an earlier form of theirs failed."""

import os
import random

import pytest
from oracle import duck_rows, spark_rows

from lodestrata.operators import lexical, passages, quotes
from lodestrata.plans import catalogue

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
LINES = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_returnflag string"


@pytest.fixture
def equals_sql(spark, tmp_path):
    def check(name, **tables):
        for table, (rows, schema) in tables.items():
            spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{table}.parquet")
        found = spark_rows(catalogue.QUERIES[name](spark, str(tmp_path)))
        assert found == duck_rows(catalogue.ORACLES[name], str(tmp_path)) and found[1]
        return found[1]

    return check


def test_union_of_rankings_has_ties(equals_sql):
    rows = [(1, 10 + i, 1, 1, 50.0, 9.0, "N") for i in range(7)] + [(2, 30, 1, 1, 50.0, 9.0, "N"), (None, 31, 1, 1, 50.0, 9.0, "N"), (5, 32, 1, None, 60.0, None, "N"), (5, 32, 1, 2, 60.0, 8.0, "N"), (7, 33, None, 1, 1.0, 1.0, "N")]
    assert len(equals_sql("union_of_rankings", lineitem=(rows, LINES))) > 5


def test_known_pairs_of_one_key(equals_sql):
    rows = [(1, part, supp, 1, 1.0, 1.0, flag) for supp, part, flag in [(1, 1_000_004, "R"), (2, 1, "N"), (2, 1, None), (3, 1, "N"), (3, 1, "R"), (None, 1, "R"), (None, 1, "N"), (4, None, "N"), (5, 7, None)]]
    equals_sql("known_pairs", lineitem=(rows, LINES))


def test_tfidf_in_small_blocks_is_the_join_on_terms(spark, monkeypatch):
    rng = random.Random(3)
    rows = [(i, " ".join(f"w{min(rng.randrange(60), rng.randrange(60))}" for _ in range(rng.randrange(1, 40)))) for i in range(90)] + [(100, ""), (101, None), (None, "w1 w2 w3")]
    docs = spark.createDataFrame(rows, "id long, text string").repartition(3)
    weights = lexical.tfidf(docs, "id", "text")
    expected = sorted(map(tuple, lexical.tfidf_top_k(weights, weights.where("id % 20 = 0"), "id", 4).collect()))
    monkeypatch.setattr(lexical, "tfidf_top_k", None)
    for size in (lexical.BLOCK_BYTES, 2_000):
        found = sorted(map(tuple, lexical.tfidf_nearest(docs, "id % 20 = 0", "id", "text", 4, block_bytes=size).collect()))
        assert found == expected and len(found) == 20


def test_quotes_of_every_length_in_small_blocks(spark, tmp_path, monkeypatch):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(6)]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randrange(30))) for _ in range(60)] + [None, "", "  W1\t w2\n\nw3  "]
    items = [(i, " ".join(rng.choice(words) for _ in range(1 + i % 6))) for i in range(40)] + [(50, None), (51, "W1 w2 W3"), (52, "1 w2 w3 w")]
    spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    expected = duck_rows(catalogue.ORACLES["quote_grounding"], str(tmp_path))
    assert spark_rows(catalogue.QUERIES["quote_grounding"](spark, str(tmp_path))) == expected
    tables = [spark.read.parquet(f"{tmp_path}/{t}.parquet") for t in ("benchmark", "documents")]
    frame = quotes.quote_counts(tables[0], "item_id", "text", tables[1], "text", "n_documents", 500)
    assert spark_rows(frame) == expected and "Generate" not in frame._jdf.queryExecution().toString()


def test_best_passages_shuffle_texts_only(spark):
    rows = [(1, "one two\n\nthree four one\nfive"), (2, ""), (3, None), (None, "one"), (4, "x y\nx y z")]
    docs = spark.createDataFrame(rows, "d int, t string")
    frame = passages.best_passages(docs, docs.selectExpr("d", "'a' as c", "'one four z' as q"), "d", "t", "c", "q")
    assert sorted((r["d"], r["c"], r["place"], r["first_line"], r["n_lines"]) for r in frame.collect()) == [(1, "a", 1, 2, 1), (1, "a", 2, 0, 1), (4, "a", 1, 1, 1)]
    assert "Generate" not in frame._jdf.queryExecution().toString()
