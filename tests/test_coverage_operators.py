"""Operators that no query with SQL covers: databases, hash draws of other engines, cuts made one after another."""

import hashlib
import uuid

import pytest
from pyspark.sql import functions as F

from lodestrata.functions import hashing
from lodestrata.operators import adapters, joins, metrics, sampling, windows
from lodestrata.operators.contracts import ContractError
from lodestrata.sources import readers, writers


@pytest.fixture(scope="module")
def database(spark):
    """An embedded database with an information schema of its own."""
    url = f"jdbc:derby:memory:t{uuid.uuid4().hex};create=true"
    spark._jvm.java.lang.Class.forName("org.apache.derby.iapi.jdbc.AutoloadedDriver")
    connection = spark._jvm.java.sql.DriverManager.getConnection(url)
    statement = connection.createStatement()
    for sql in (
        "CREATE SCHEMA shop",
        "CREATE TABLE shop.item (id INT, name VARCHAR(20))",
        "INSERT INTO shop.item VALUES (1, 'a'), (2, NULL)",
        "CREATE TABLE shop.sale (id INT, price DOUBLE)",
        "INSERT INTO shop.sale VALUES (1, 2.5)",
        "CREATE SCHEMA information_schema",
        "CREATE TABLE information_schema.tables (table_schema VARCHAR(40), table_name VARCHAR(40), table_type VARCHAR(40))",
        "INSERT INTO information_schema.tables VALUES ('shop', 'item', 'BASE TABLE'), ('shop', 'sale', 'BASE TABLE'), ('shop', 'seen', 'VIEW'), ('pg_catalog', 'x', 'BASE TABLE')",
    ):
        statement.execute(sql)
    yield url
    connection.close()


def test_database_tables_by_name_and_by_discovery(spark, database):
    one = readers.read_database(spark, database, ["shop.item"])
    assert sorted(map(tuple, one["shop.item"].collect())) == [(1, "a"), (2, None)]
    found = readers.read_database(spark, database)
    assert sorted(found) == ["shop.item", "shop.sale"] and found["shop.sale"].collect()[0]["PRICE"] == 2.5


def test_draws_and_ids_of_other_engines(spark):
    rows = spark.createDataFrame([("a", 1), ("b", 22)], "p string, n int")
    space = "6ba7b810-9dad-11d1-80b4-00c04fd430c8"
    for r in rows.select("p", "n", hashing.blake_fraction(F.col("p"), F.col("n")).alias("u"), hashing.name_uuid(space, F.col("p"), F.col("n")).alias("id")).collect():
        assert r["u"] == int.from_bytes(hashlib.blake2b(f"{r['p']}\x00{r['n']}".encode(), digest_size=8).digest(), "big") / 2**64
        assert r["id"] == str(uuid.uuid5(uuid.UUID(space), f"{r['p']}:{r['n']}"))


def test_packed_bins_keep_every_row(spark):
    rows = [(i, n) for i, n in enumerate([5, 3, 9, 20, 2, 7, None, 1, 10])]
    found = sampling.packed_bins(spark.createDataFrame(rows, "id long, n long"), "id", "n", 10).collect()
    assert sorted(r["id"] for r in found) == list(range(9))
    bins = {}
    for r in found:
        bins.setdefault(r["bin"], []).append(dict(rows)[r["id"]] or 0)
    assert all(sum(b) <= 10 or len(b) == 1 for b in bins.values()) and [20] in bins.values() and len(bins) == 5


def test_micro_batches_equal_brute_force(spark):
    rows = [(i, (i * 7919) % 50 + 1) for i in range(200)] + [(200, 500)]
    found = {r["id"]: r["batch"] for r in sampling.micro_batches(spark.createDataFrame(rows, "id long, n long"), "id", "n", 200).collect()}
    expected, batch, longest, held = {}, -1, 0, 0
    for i, n in sorted(rows, key=lambda r: (-r[1], r[0])):
        if batch < 0 or longest * (held + 1) > 200:
            batch, longest, held = batch + 1, n, 0
        held += 1
        expected[i] = batch
    assert found == expected


def test_ring_samples_have_other_items_once(spark):
    ids = spark.range(40)
    found = sampling.ring_sample(ids.select(F.col("id").alias("q")), ids.select(F.col("id").alias("i")), "q", "i", 5, "s").collect()
    by = {}
    for r in found:
        by.setdefault(r["q"], []).append(r["i"])
    assert len(by) == 40 and all(len(set(v)) == 5 and q not in v for q, v in by.items())
    few = sampling.ring_sample(ids.limit(3).select(F.col("id").alias("q")), ids.limit(3).select(F.col("id").alias("i")), "q", "i", 5, "s").collect()
    assert sorted((r["q"], r["i"]) for r in few) == [(a, b) for a in range(3) for b in range(3) if a != b]
    assert sampling.ring_sample(ids.select(F.col("id").alias("q")), ids.limit(0).select(F.col("id").alias("i")), "q", "i", 5, "s").count() == 0


def test_ranges_by_halving(spark):
    bounds = [1.0, 2.5, 7.0]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in (0.0, 1.0, 1.5, 2.5, 3.0, 7.0, 8.0)], "x double").select(windows.range_number(F.col("x"), bounds)).collect()]
    assert got == [0, 0, 1, 1, 2, 2, 3]
    rows = spark.range(1000).select((F.col("id") % 37).cast("double").alias("x"), F.col("id").alias("v")).groupBy("x").agg(F.sum("v").alias("v"))
    for buckets in (None, 1, 5):
        found = {r["x"]: r["cum_v"] for r in windows.running_totals(rows, "x", ["v"], buckets).collect()}
        assert found == {float(x): sum(v for v in range(1000) if v % 37 <= x) for x in range(37)}
    assert windows.running_totals(rows.limit(0), "x", ["v"]).count() == 0


def test_open_counts_with_open_ends(spark):
    spans = spark.createDataFrame([(1, "2020-01-02", "2020-01-03"), (2, None, "2020-01-01"), (3, "2020-01-03", None), (4, None, None), (5, "2021-01-01", "2021-02-01")], "id int, a string, b string").selectExpr("id", "to_date(a) AS a", "to_date(b) AS b")
    days = spark.createDataFrame([("2020-01-01", 5), ("2020-01-03", 2), ("2020-01-09", 1), (None, 100)], "d string, n long").selectExpr("to_date(d) AS d", "n")
    assert {r["id"]: r["n_open"] for r in joins.open_counts(spans, days, "a", "b", "d", "n", "n_open").collect()} == {1: 2, 2: 5, 3: 3, 4: 8, 5: 0}


def test_bootstrap_of_an_auroc(spark):
    rows = spark.range(60).select(F.col("id").alias("unit"), (F.col("id") % 2).cast("int").alias("y"), ((F.col("id") * 7919) % 100 + (F.col("id") % 2) * 40).cast("double").alias("s"))
    found = metrics.bootstrap_metric(rows, "unit", lambda t: metrics.auroc(t, "y", "s", "weight", ["draw"], "value"), 40, "x").first()
    whole = metrics.auroc(rows, "y", "s").first()["auroc"]
    assert found["n_units"] == 60 and found["draws"] == 40 and found["low"] < whole < found["high"]
    assert metrics.bootstrap_metric(rows.limit(0), "unit", lambda t: t, 4, "x").count() == 0


def test_adapters_need_a_table(spark):
    make = {"a": adapters.adapter(F.col("id"), F.col("id"), F.lit("x"))}
    assert adapters.examples(make, {"a": spark.range(3)}).count() == 3
    with pytest.raises(ContractError):
        adapters.examples(make, {}, ["a"])


def test_a_failed_publication_keeps_the_old_table(spark, tmp_path):
    path = f"{tmp_path}/t.parquet"
    writers.publish(spark.range(3).toDF("a"), path)
    with pytest.raises(Exception):  # noqa: B017
        writers.publish(spark.range(3).select(F.raise_error(F.lit("no")).alias("a")), path)
    assert spark.read.parquet(path).count() == 3
    assert [writers.append_journal(spark.range(1), f"{tmp_path}/j", "x") for _ in range(2)] == [True, False]


def test_versions_are_whole_and_few(spark, tmp_path):
    import os

    path = f"{tmp_path}/v"
    with pytest.raises(ContractError):
        writers.current_version(spark, path)
    for i in range(4):
        writers.publish_version(spark.range(i + 1), path)
        with pytest.raises(Exception):  # noqa: B017
            writers.publish_version(spark.range(3).select(F.raise_error(F.lit("no")).alias("a")), path)
        assert writers.current_version(spark, path).count() == i + 1
    assert sorted(n for n in os.listdir(path) if n.startswith("version-")) == ["version-00000003", "version-00000004"]
