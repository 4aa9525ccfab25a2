"""Sources and sinks: tables written by a sink into the shared folder and read back by a reader."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import dedup
from ..sources import arrays, readers, shared, writers
from .registry import query, table


def _place(spark, name):
    """A path that no other run has; its ending names the format."""
    return shared.written_path(spark, "source-query") + "-" + name


@query("""SELECT o_orderkey, CASE o_orderkey % 7 WHEN 0 THEN 'None' WHEN 1 THEN 'NA' WHEN 2 THEN 'null' WHEN 3 THEN NULL WHEN 4 THEN 'a "quoted", cell' WHEN 5 THEN 'NaN' ELSE 'two' || chr(10) || 'lines' END AS cell FROM orders""")
def csv_literals(spark, sf_dir):
    """CSV cells that look like missing values stay text; only an empty cell is null."""
    cells = F.element_at(F.array(*(F.lit(x) for x in ("None", "NA", "null", None, 'a "quoted", cell', "NaN", "two\nlines"))), (F.col("o_orderkey") % 7 + 1).cast("int"))
    path = writers.publish(table(spark, sf_dir, "orders").select("o_orderkey", cells.alias("cell")), _place(spark, "a.csv"), "csv", header="true", quote='"', escape='"', nullValue="")
    return readers.read_clinical_csv(spark, path, "o_orderkey bigint, cell string")


@query("SELECT f AS format, n_nationkey::BIGINT AS n_nationkey, n_name FROM nation, (SELECT unnest(['csv', 'jsonl', 'parquet']) AS f)")
def format_dispatch(spark, sf_dir):
    """One table in three formats, each read by its path's ending."""
    frame = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    parts = []
    for ending, fmt, options in (("csv", "csv", {"header": "true"}), ("jsonl", "json", {}), ("parquet", "parquet", {})):
        path = writers.publish(frame, _place(spark, f"a.{ending}"), fmt, **options)
        parts.append(readers.read_table(spark, path, ["n_nationkey", "n_name"]).select(F.lit(ending).alias("format"), F.col("n_nationkey").cast("bigint").alias("n_nationkey"), "n_name"))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 100000")
def pruned_columns(spark, sf_dir):
    """Of the wanted columns those that exist; the filter reaches the scan."""
    return readers.read_table(spark, f"{sf_dir}/orders.parquet", ["o_orderkey", "no_such_column", "o_totalprice"]).where("o_totalprice > 100000")


@query("SELECT l_returnflag, count(*) AS n, CAST(sum(l_quantity) AS BIGINT) AS quantity FROM lineitem GROUP BY l_returnflag")
def chunked_csv_scan(spark, sf_dir):
    """A CSV without line ends in cells, read in splits and added up."""
    frame = table(spark, sf_dir, "lineitem").select("l_returnflag", F.col("l_quantity").cast("bigint").alias("l_quantity"))
    path = writers.publish(frame, _place(spark, "a.csv"), "csv", header="true")
    rows = readers.read_clinical_csv(spark, path, "l_returnflag string, l_quantity bigint", one_line=True)
    return rows.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("quantity"))


def _listings(spark, sf_dir):
    """Customers as a nested export in files of up to 1,000 records, read by the listing reader; every tenth record has no id."""
    key = F.col("c_custkey")
    nested = F.struct(
        F.struct(F.when(key % 10 != 0, F.concat(F.lit("NCT"), F.lpad(key.cast("string"), 8, "0"))).alias("nctId"), F.col("c_name").alias("briefTitle")).alias("identificationModule"),
        F.struct(F.col("c_mktsegment").alias("overallStatus"), F.struct(F.lit("2021-05").alias("date"), F.when(key % 2 == 0, "ACTUAL").alias("type")).alias("startDateStruct"), F.struct(F.when(key % 3 == 0, "2024-01-31").alias("date")).alias("completionDateStruct")).alias("statusModule"),
        F.struct(F.lit("INTERVENTIONAL").alias("studyType"), F.when(key % 4 == 0, F.array(F.lit("PHASE1"), F.lit("PHASE2"))).when(key % 4 == 1, F.array(F.lit("PHASE3"))).alias("phases")).alias("designModule"),
        F.struct(F.array(F.col("c_mktsegment")).alias("conditions")).alias("conditionsModule"),
        F.struct(F.when(key % 5 == 0, "ALL").otherwise("FEMALE").alias("sex"), F.concat((key % 60 + 18).cast("string"), F.lit(" Years")).alias("minimumAge")).alias("eligibilityModule"),
    )
    records = table(spark, sf_dir, "customer").select((key / 1000).cast("int").alias("part"), F.to_json(F.struct(nested.alias("protocolSection"))).alias("record"))
    files = records.groupBy("part").agg(F.concat(F.lit("["), F.array_join(F.collect_list("record"), ","), F.lit("]")).alias("value"))
    path = _place(spark, "listings")
    files.write.partitionBy("part").text(path)
    return readers.read_listings(spark, path)


@query("""
SELECT 'NCT' || lpad(c_custkey::VARCHAR, 8, '0') AS nct_id, c_name AS title, 'INTERVENTIONAL' AS study_type, CASE c_custkey % 4 WHEN 0 THEN 'PHASE1,PHASE2' WHEN 1 THEN 'PHASE3' ELSE '' END AS phases, c_name AS trial_text
FROM customer WHERE c_custkey % 10 <> 0""")
def listing_records(spark, sf_dir):
    """A nested export as flat rows; records without an id are left out."""
    return _listings(spark, sf_dir).select("nct_id", "title", "study_type", F.array_join("phases", ",").alias("phases"), "trial_text")


@query("""
SELECT 'NCT' || lpad(c_custkey::VARCHAR, 8, '0') AS nct_id, c_mktsegment AS overall_status, '2021-05' AS study_start_date, CASE WHEN c_custkey % 2 = 0 THEN 'ACTUAL' ELSE '' END AS study_start_date_type,
  '' AS primary_completion_date, '' AS primary_completion_date_type, CASE WHEN c_custkey % 3 = 0 THEN '2024-01-31' ELSE '' END AS completion_date, '' AS completion_date_type, '' AS last_update_post_date, '' AS study_first_post_date_type
FROM customer WHERE c_custkey % 10 <> 0""")
def listing_dates(spark, sf_dir):
    """The status and the dates of the export, missing ones empty."""
    return _listings(spark, sf_dir).select("nct_id", "overall_status", "study_start_date", "study_start_date_type", "primary_completion_date", "primary_completion_date_type", "completion_date", "completion_date_type", "last_update_post_date", "study_first_post_date_type")


@query("""
SELECT 'NCT' || lpad(c_custkey::VARCHAR, 8, '0') AS nct_id, c_mktsegment AS conditions, CASE WHEN c_custkey % 5 = 0 THEN 'ALL' ELSE 'FEMALE' END AS sex, (c_custkey % 60 + 18) || ' Years' AS minimum_age, '' AS maximum_age
FROM customer WHERE c_custkey % 10 <> 0""")
def listing_details(spark, sf_dir):
    """Conditions, sex and ages of the export."""
    return _listings(spark, sf_dir).select("nct_id", F.array_join("conditions", ",").alias("conditions"), "sex", "minimum_age", "maximum_age")


@query("SELECT n_nationkey::BIGINT AS n_nationkey, n_name FROM nation")
def paged_listing(spark, sf_dir):
    """All pages of a service of ten rows a page, in the order of their tokens."""
    frame = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("bigint").alias("n_nationkey"), "n_name")

    def fetch(token):
        rows = frame.where(F.col("n_nationkey") > int(token or -1)).orderBy("n_nationkey").limit(10).collect()  # a page
        return {"studies": [r.asDict() for r in rows]} | ({"nextPageToken": str(rows[-1]["n_nationkey"])} if len(rows) == 10 else {})

    return spark.createDataFrame(list(readers.read_pages(fetch)), "n_nationkey bigint, n_name string")


@query("SELECT c_custkey, c_name, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_acctbal END AS c_acctbal FROM customer")
def json_lines_round_trip(spark, sf_dir):
    """JSON lines, published and read with a schema; nulls stay null."""
    frame = table(spark, sf_dir, "customer").select("c_custkey", "c_name", F.when(F.col("c_custkey") % 3 != 0, F.col("c_acctbal")).alias("c_acctbal"))
    path = writers.publish(frame, _place(spark, "a.jsonl"), "json")
    return readers.read_table(spark, path, schema=", ".join(f"{c} {t}" for c, t in frame.dtypes))


@query("SELECT count(*) AS n_rows, CAST(sum(l_orderkey) AS BIGINT) AS sum_keys FROM lineitem")
def parquet_batches(spark, sf_dir):
    """A table read in Arrow batches, each reduced as it comes."""
    import pyarrow as pa
    import pyarrow.compute as pc

    def reduce(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([pc.sum(b.column(0)).as_py() or 0])], ["n_rows", "sum_keys"])

    parts = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").cast("bigint")).mapInArrow(reduce, "n_rows bigint, sum_keys bigint")
    return parts.agg(F.sum("n_rows").alias("n_rows"), F.sum("sum_keys").alias("sum_keys"))


@query("SELECT event_id, user_id, event_type FROM events WHERE event_type IN ('click', 'purchase') AND user_id IN (1, 2, 3, 5, 8, 13, 21, 34)")
def pushed_isin(spark, sf_dir):
    """Rows of a few keys and kinds; both lists are pushed to the scan."""
    return readers.read_table(spark, f"{sf_dir}/events.parquet", ["event_id", "user_id", "event_type"]).where(F.col("event_type").isin("click", "purchase") & F.col("user_id").isin(1, 2, 3, 5, 8, 13, 21, 34))


@query("SELECT n_nationkey::BIGINT AS n_nationkey, 'Pays ' || n_name || ' é ü' AS label FROM nation")
def pipes_latin_1(spark, sf_dir):
    """Fields between pipes in Latin-1."""
    frame = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("bigint").alias("n_nationkey"), F.concat(F.lit("Pays "), "n_name", F.lit(" é ü")).alias("label"))
    path = writers.publish(frame, _place(spark, "a.psv"), "csv", header="true", sep="|", encoding="ISO-8859-1")
    return readers.read_clinical_csv(spark, path, "n_nationkey bigint, label string", "|", "ISO-8859-1")


@query("SELECT s_suppkey, s_name, CASE WHEN s_suppkey % 2 = 0 THEN 'second' ELSE 'first' END AS origin FROM supplier")
def inputs_once(spark, sf_dir):
    """Several inputs, some named twice, with other columns each; rows that repeat a key once."""
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    odd, even = (rows.where(F.col("s_suppkey") % 2 == r).withColumn("origin", F.lit(o)) for r, o in ((1, "first"), (0, "second")))
    a, b = writers.publish(odd, _place(spark, "a.parquet")), writers.publish(even.withColumn("extra", F.lit(1)), _place(spark, "b.parquet"))
    c = writers.publish(odd, _place(spark, "c.jsonl"), "json")
    return readers.read_many(spark, [a, b, a, c], dedupe=["s_suppkey"]).select("s_suppkey", "s_name", "origin")


@query("SELECT o_custkey, max(o_orderkey) AS last_key, count(*) AS n FROM orders GROUP BY o_custkey")
def gzip_checkpoints(spark, sf_dir):
    """Checkpoints as gzipped JSON, the latest of each key."""
    frame = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey")
    path = writers.publish(frame, _place(spark, "a.json"), "json", compression="gzip")
    rows = readers.read_table(spark, path, schema="o_custkey bigint, o_orderkey bigint")
    return rows.groupBy("o_custkey").agg(F.max("o_orderkey").alias("last_key"), F.count(F.lit(1)).alias("n"))


@query("SELECT r_regionkey::BIGINT AS r_regionkey, r_name FROM region")
def wrapped_json(spark, sf_dir):
    """JSON files that are arrays or objects around them, one row a region in each form in turn."""
    names = ("records", "trialSpaces", "trial_spaces", "data", None)
    row = F.to_json(F.struct(F.col("r_regionkey").cast("bigint").alias("r_regionkey"), "r_name"))
    forms = [F.concat(F.lit("["), row, F.lit("]")) if n is None else F.concat(F.lit(f'{{"{n}": ['), row, F.lit("]}")) for n in names]
    value = F.element_at(F.array(*forms), (F.col("r_regionkey") % 5 + 1).cast("int"))
    path = _place(spark, "wrapped")
    table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("part"), value.alias("value")).write.partitionBy("part").text(path)
    return readers.read_wrapped_json(spark, path, "r_regionkey bigint, r_name string")


@query("SELECT d.doc_id, length(d.text) AS n_chars, sha256(d.text) AS digest FROM documents d JOIN (SELECT DISTINCT doc_id FROM labels WHERE quality = 0) l USING (doc_id)")
def wide_rows_by_key(spark, sf_dir):
    """The texts of some keys only: keys first, wide columns by a semi join."""
    wanted = table(spark, sf_dir, "labels").where("quality = 0")
    return readers.read_rows_by_key(table(spark, sf_dir, "documents"), "doc_id", wanted, ["text"]).select("doc_id", F.char_length("text").cast("bigint").alias("n_chars"), F.sha2("text", 256).alias("digest"))


@query("SELECT o_custkey AS id, string_agg(o_orderkey::VARCHAR, ' ' ORDER BY o_orderkey) AS ids FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) GROUP BY o_custkey")
def token_array_slices(spark, sf_dir):
    """Order keys as packed arrays; the slices of customers with a balance through the index."""
    lists = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.array_sort(F.collect_list("o_orderkey")).alias("keys"))
    path = writers.publish(arrays.packed_arrays(lists, "o_custkey", "keys", 500), _place(spark, "arrays.parquet"))
    wanted = table(spark, sf_dir, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("id"))
    return arrays.array_slices(spark.read.parquet(path), wanted).select("id", F.array_join("ids", " ").alias("ids"))


@query("SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY c_mktsegment")
def cached_columns(spark, sf_dir):
    """Two columns kept in a cache by the table's size and time; the second read comes from there."""
    cache = _place(spark, "cache")
    for _ in range(2):
        kept = readers.cached_columns(spark, f"{sf_dir}/customer.parquet", ["c_custkey", "c_mktsegment"], cache)
    return kept.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT count(*) AS n_rows, 0::BIGINT AS n_broken FROM orders")
def block_sampled(spark, sf_dir):
    """Whole blocks of a table's files: two samples that share a draw split the table, and no block is in both."""
    path = f"{sf_dir}/orders.parquet"
    low = readers.block_sample(spark, path, 0.5, "draw").select("block_file", "block_start", F.lit(1).alias("half"))
    rest = readers.block_sample(spark, path, 1.0, "draw").select("block_file", "block_start", F.lit(2).alias("half")).join(low.drop("half").distinct(), ["block_file", "block_start"], "left_anti")
    blocks = low.unionByName(rest.select(*low.columns)).groupBy("block_file", "block_start").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("half").alias("halves"))
    return blocks.agg(F.sum("n").alias("n_rows"), F.coalesce(F.sum((F.col("halves") - 1).cast("bigint")), F.lit(0)).cast("bigint").alias("n_broken"))


@query("SELECT r_regionkey::BIGINT AS r_regionkey, r_name FROM region WHERE r_regionkey > 0")
def published_anew(spark, sf_dir):
    """A table published over an earlier one: readers see the later rows alone."""
    frame, path = table(spark, sf_dir, "region").select(F.col("r_regionkey").cast("bigint").alias("r_regionkey"), "r_name"), _place(spark, "a.parquet")
    writers.publish(frame, path)
    return spark.read.parquet(writers.publish(frame.where("r_regionkey > 0"), path))


@query("SELECT n_nationkey::BIGINT AS n_nationkey, n_name FROM nation WHERE n_nationkey % 3 = 2")
def published_versions(spark, sf_dir):
    """Three versions of a table, each seen whole; the last one is current."""
    frame, path = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("bigint").alias("n_nationkey"), "n_name"), _place(spark, "versions")
    for i in range(3):
        writers.publish_version(frame.where(F.col("n_nationkey") % 3 == i), path)
    return writers.current_version(spark, path)


@query("SELECT doc_id, length(coalesce(text, '')) AS n_chars FROM documents")
def published_texts(spark, sf_dir):
    """Texts in zstd Parquet with large dictionary pages, private to their owner."""
    path = writers.publish_text_heavy(table(spark, sf_dir, "documents").select("doc_id", "text"), _place(spark, "texts.parquet"))
    writers.make_private(spark, path)
    return spark.read.parquet(path).select("doc_id", F.char_length(F.coalesce("text", F.lit(""))).cast("bigint").alias("n_chars"))


@query("""
SELECT 'all' AS output, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS sum_keys FROM orders
UNION ALL SELECT 'open', count(*), CAST(sum(o_orderkey) AS BIGINT) FROM orders WHERE o_orderstatus = 'O'
UNION ALL SELECT 'other', count(*), CAST(sum(o_orderkey) AS BIGINT) FROM orders WHERE o_orderstatus <> 'O'""")
def outputs_of_one_pass(spark, sf_dir):
    """Three tables from one computation."""
    frame, base = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus"), _place(spark, "out")
    names = {"all": None, "open": F.col("o_orderstatus") == "O", "other": F.col("o_orderstatus") != "O"}
    paths = writers.publish_outputs(frame, {f"{base}/{n}.parquet": c for n, c in names.items()})
    parts = [spark.read.parquet(p).agg(F.lit(n).alias("output"), F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").cast("bigint").alias("sum_keys")) for n, p in zip(names, paths, strict=True)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("SELECT f AS form, p_partkey, p_name, CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE p_brand END AS p_brand FROM part, (SELECT unnest(['csv', 'parquet']) AS f)")
def exported_twice(spark, sf_dir):
    """The same rows as Parquet and as CSV, nulls as empty cells."""
    frame = table(spark, sf_dir, "part").select("p_partkey", "p_name", F.when(F.col("p_partkey") % 4 != 0, F.col("p_brand")).alias("p_brand"))
    parquet, csv = writers.export_both(frame, _place(spark, "both"))
    shape = ", ".join(f"{c} {t}" for c, t in frame.dtypes)
    return spark.read.parquet(parquet).withColumn("form", F.lit("parquet")).unionByName(readers.read_clinical_csv(spark, csv, shape).withColumn("form", F.lit("csv")))


@query("SELECT '<tr><td>' || r_regionkey || '</td><td>' || r_name || ' &amp; &lt;co&gt;</td></tr>' AS line FROM region")
def html_report(spark, sf_dir):
    """A small table as an HTML page; its rows, escaped."""
    frame = table(spark, sf_dir, "region").select("r_regionkey", F.concat("r_name", F.lit(" & <co>")).alias("r_name"))
    page = spark.read.text(writers.html_report(frame, _place(spark, "page.html"), "Regions", ["r_regionkey"]))
    return page.select(F.col("value").alias("line")).where("line LIKE '<tr>%'")


@query("SELECT doc_id, arg_max(quality, step) AS quality, count(*) AS n_entries FROM (SELECT doc_id, quality, 0 AS step FROM labels UNION ALL SELECT doc_id, 1 - quality, 1 FROM labels WHERE doc_id % 4 = 0) GROUP BY doc_id")
def journal_in_batches(spark, sf_dir):
    """A journal of two batches, the second one sent twice: a repeated batch adds nothing, the latest entry wins."""
    labels, path = table(spark, sf_dir, "labels").select("doc_id", "quality"), _place(spark, "journal")
    first, second = labels.withColumn("step", F.lit(0)), labels.where("doc_id % 4 = 0").select("doc_id", (1 - F.col("quality")).alias("quality"), F.lit(1).alias("step"))
    for batch, frame in (("a", first), ("b", second), ("b", second)):
        writers.append_journal(frame, path, batch)
    rows = spark.read.schema("doc_id bigint, quality int, step int").json(path)
    return rows.groupBy("doc_id").agg(F.max_by("quality", "step").alias("quality"), F.count(F.lit(1)).alias("n_entries"))


@query("""
SELECT 'partial' AS output, count(*) AS n FROM lineitem WHERE l_quantity < 50 UNION ALL SELECT 'errors', count(*) FROM lineitem WHERE l_quantity >= 50 UNION ALL SELECT 'whole', count(*) FROM lineitem""")
def partial_outputs(spark, sf_dir):
    """A table with failed rows is published as partial, with the failed ones beside it; without any, as itself."""
    frame, path = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity"), _place(spark, "out.parquet")
    outputs = {"partial": writers.publish_partial(frame, path, F.col("l_quantity") >= 50), "errors": f"{path}.errors", "whole": writers.publish_partial(frame, path, F.col("l_quantity") < 0)}
    parts = [spark.read.parquet(p).agg(F.lit(n).alias("output"), F.count(F.lit(1)).alias("n")) for n, p in outputs.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("SELECT o_orderkey, o_totalprice FROM orders")
def composed_shards(spark, sf_dir):
    """Shards written apart and composed in order, published because the rows are as many as expected."""
    frame = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    shards = [writers.publish(frame.where(F.col("o_orderkey") % 3 == i), _place(spark, f"{i}.parquet")) for i in range(3)]
    return spark.read.parquet(writers.compose(spark, shards, _place(spark, "whole.parquet"), frame.count(), "o_orderkey"))


@query("SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN toxic END AS toxic, doc_id % 3 = 0 AND toxic IS NOT NULL AS reused FROM (SELECT doc_id, max(toxic) AS toxic FROM labels GROUP BY doc_id)")
def imported_judgments(spark, sf_dir):
    """Judgments of an earlier round for pairs that come again; the others are left to judge."""
    labels = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    earlier = labels.where("doc_id % 3 = 0").withColumn("at", F.lit(1))
    return dedup.import_judgments(labels.select("doc_id"), earlier, ["doc_id"], "toxic", "at").select("doc_id", "toxic", "reused")
