import gzip
import json
import os
import stat

import pytest
from pyspark.sql import functions as F

from lodestrata.operators.contracts import ContractError
from lodestrata.sources import readers, writers


def test_literals_survive_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,text\n1,None\n2,NA\n3,N/A\n4,null\n5,NaN\n6,\n7,"a ""b""\nc, d"\n8,""\n')
    rows = {r["id"]: r["text"] for r in readers.read_clinical_csv(spark, f"{tmp_path}/a.csv").collect()}
    assert rows == {"1": "None", "2": "NA", "3": "N/A", "4": "null", "5": "NaN", "6": None, "7": 'a "b"\nc, d', "8": None}


def test_pipe_separated_latin_1(spark, tmp_path):
    (tmp_path / "a.psv").write_bytes("id|t\n1|é\n".encode("latin-1"))
    assert readers.read_clinical_csv(spark, f"{tmp_path}/a.psv", separator="|", encoding="ISO-8859-1").first()["t"] == "é"


def test_read_table_by_suffix(spark, tmp_path):
    with gzip.open(tmp_path / "a.jsonl.gz", "wt") as f:
        f.write('{"a": 1, "b": "x"}\n')
    spark.range(2).withColumnRenamed("id", "a").write.parquet(f"{tmp_path}/b.parquet")
    assert readers.read_table(spark, f"{tmp_path}/a.jsonl.gz", ["b", "zz"]).collect() == [("x",)]
    assert readers.read_many(spark, [f"{tmp_path}/a.jsonl.gz", f"{tmp_path}/b.parquet", f"{tmp_path}/b.parquet"]).count() == 3
    assert readers.read_many(spark, [f"{tmp_path}/a.jsonl.gz", f"{tmp_path}/b.parquet"], dedupe=["a"]).count() == 2
    with pytest.raises(ContractError):
        readers.read_table(spark, "x.bin")


def test_wrapped_json(spark, tmp_path):
    rows = [{"id": "a", "text": "x"}, {"id": "b"}]
    for name, value in (("array", rows), ("records", {"records": rows}), ("spaces", {"trial_spaces": rows})):
        (tmp_path / f"{name}.json").write_text(json.dumps(value))
        assert [tuple(r) for r in readers.read_wrapped_json(spark, f"{tmp_path}/{name}.json", "id string, text string").collect()] == [("a", "x"), ("b", None)]


def listing(i):
    return {"protocolSection": {"identificationModule": {"nctId": f"NCT{i:08d}", "briefTitle": f"T{i}"}, "statusModule": {"startDateStruct": {"date": "2021-05", "type": "ACTUAL"}}, "designModule": {"phases": ["PHASE1"]}}}


def test_listings(spark, tmp_path):
    (tmp_path / "x.json").write_text(json.dumps([listing(1), {"protocolSection": {}}, {"other": 1}, listing(2)]))
    rows = readers.read_listings(spark, f"{tmp_path}/x.json").orderBy("nct_id").collect()
    assert [r["nct_id"] for r in rows] == ["NCT00000001", "NCT00000002"]
    assert rows[0]["study_start_date"] == "2021-05" and rows[0]["completion_date"] == "" and rows[0]["phases"] == ["PHASE1"] and rows[0]["trial_text"] == "T1"


def test_paginated_source(spark, tmp_path):
    (tmp_path / "first.json").write_text(json.dumps({"studies": [listing(1), listing(2)], "nextPageToken": "p2"}))
    (tmp_path / "p2.json").write_text(json.dumps({"studies": [listing(3)]}))
    spark.dataSource.register(readers.ListingSource)
    assert spark.read.format("listings").option("url", f"file://{tmp_path}").load().count() == 3
    some = spark.read.format("listings").option("url", f"file://{tmp_path}").option("ids", "NCT00000003,NCT00000009").load()
    assert some.count() == 1 and readers.missing_ids(some, ["NCT00000003", "NCT00000009"]) == ["NCT00000009"]


def test_page_token_cycle():
    with pytest.raises(ContractError, match="twice"):
        list(readers.read_pages(lambda t: {"studies": [], "nextPageToken": "a"}))


def test_publish_replaces_whole_tables(spark, tmp_path):
    path = f"{tmp_path}/t.parquet"
    writers.publish(spark.range(3).toDF("a"), path)
    writers.publish(spark.range(5).toDF("a"), path)
    assert spark.read.parquet(path).count() == 5 and os.listdir(tmp_path) == ["t.parquet"]
    writers.make_private(spark, path)
    assert stat.S_IMODE(os.stat(path).st_mode) == 0o700


def test_partial_and_composed_outputs(spark, tmp_path):
    frame = spark.range(4).toDF("a")
    assert writers.publish_partial(frame, f"{tmp_path}/ok.parquet", F.col("a") < 0).endswith("ok.parquet")
    assert writers.publish_partial(frame, f"{tmp_path}/bad.parquet", F.col("a") == 2).endswith(".partial")
    assert spark.read.parquet(f"{tmp_path}/bad.parquet.errors").count() == 1
    writers.compose(spark, [f"{tmp_path}/ok.parquet", f"{tmp_path}/bad.parquet.partial"], f"{tmp_path}/all.parquet", 7)
    with pytest.raises(ContractError):
        writers.compose(spark, [f"{tmp_path}/ok.parquet"], f"{tmp_path}/all2.parquet", 7)
    outs = writers.publish_outputs(frame, {f"{tmp_path}/x.parquet": None, f"{tmp_path}/y.parquet": F.col("a") > 1})
    assert [spark.read.parquet(p).count() for p in outs] == [4, 2]
    writers.export_both(spark.createDataFrame([(1, ["a"], None)], "a int, b array<string>, c string"), f"{tmp_path}/both")
    assert readers.read_clinical_csv(spark, f"{tmp_path}/both.csv").collect() == [("1", '["a"]', None)]


def test_journal_appends(spark, tmp_path):
    for i in range(2):
        writers.append_journal(spark.createDataFrame([(i, "x")], "at int, choice string"), f"{tmp_path}/j")
    assert spark.read.json(f"{tmp_path}/j").count() == 2
