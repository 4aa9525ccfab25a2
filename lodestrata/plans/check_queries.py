"""Contracts, projections, joins, orders, sets, draws, parsers, scorers and stages, one query for each operator."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates, hashing, masking, scores, seeds, text
from ..operators import adapters, contracts, dedup, histories, joins, metrics, ranking, sampling, scoring, windows
from ..sources import shared, writers
from . import stages
from .registry import query, table


def _pick(values, key="doc_id"):
    """One of several constants by a key's remainder."""
    return F.element_at(F.array(*(F.lit(v) for v in values)), (F.col(key) % len(values) + 1).cast("int"))


def _sql_list(values):
    return "[" + ", ".join("NULL" if v is None else "'" + v.replace("'", "''").replace("\n", "' || chr(10) || '") + "'" for v in values) + "]"


def _day(column):
    return F.date_format(column, "yyyy-MM-dd")


# contracts


@query("""
WITH t AS (SELECT o_orderkey, o_orderdate::DATE AS opened, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderdate::DATE + (o_orderkey % 900)::INT END AS closed, CASE WHEN o_orderkey % 7 = 0 THEN 'OPEN' ELSE 'CLOSED' END AS status FROM orders)
SELECT o_orderkey, (coalesce(year(closed) < 1996, false) OR coalesce(year(opened) > 1996, false)) AND status <> 'OPEN' AS outside FROM t""")
def outside_years(spark, sf_dir):
    """Studies closed to a year: a missing end is open, and a status overrides."""
    opened, key = F.to_date("o_orderdate"), F.col("o_orderkey")
    closed = F.when(key % 5 != 0, F.date_add(opened, (key % 900).cast("int")))
    status = F.when(key % 7 == 0, "OPEN").otherwise("CLOSED")
    return table(spark, sf_dir, "orders").select("o_orderkey", joins.outside_years(opened, closed, 1996, 1996, status, "OPEN").alias("outside"))


_WHOLE = "Age Sex Cancer type allowed: x Histology Cancer burden allowed: y Prior treatment required: z Prior treatment excluded: Biomarker requirements: w"
_TEXTS = (_WHOLE, _WHOLE.replace("Histology ", ""), _WHOLE.replace("Prior treatment excluded:", ""), _WHOLE.replace("Cancer type allowed:", "Cancer primary site allowed:"), None, "")


@query("SELECT doc_id, doc_id % 6 IN (0, 3) AS whole FROM documents")
def required_fields(spark, sf_dir):
    """Descriptions that have one alternative of every required field."""
    return table(spark, sf_dir, "documents").select("doc_id", text.has_required_fields(_pick(_TEXTS)).alias("whole"))


@query("SELECT l_partkey, count(DISTINCT l_returnflag) AS n_splits FROM lineitem GROUP BY l_partkey HAVING count(DISTINCT l_returnflag) > 1")
def split_conflicts(spark, sf_dir):
    """Keys that stand in more than one split."""
    return contracts.split_conflicts(table(spark, sf_dir, "lineitem"), "l_partkey", "l_returnflag")


@query("SELECT c_custkey AS id, c_name AS name FROM customer")
def aliased_columns(spark, sf_dir):
    """Columns under the first of several names that the table has."""
    frame = contracts.require_columns(table(spark, sf_dir, "customer"), ["c_custkey"])
    pick = lambda names: F.col(contracts.first_existing(frame, names))
    return frame.select(pick(["id", "c_custkey", "custkey"]).alias("id"), pick(["full_name", "c_name"]).alias("name"))


@query("SELECT event_id, json_keys(props) = ['k'] AS same_fields FROM events")
def nested_fields(spark, sf_dir):
    """Whether a nested object has exactly the expected fields."""
    return table(spark, sf_dir, "events").select("event_id", F.coalesce(F.array_sort(F.json_object_keys("props")) == F.array(F.lit("k")), F.lit(False)).alias("same_fields"))


@query("SELECT o_orderkey FROM orders WHERE o_orderkey % 10 = 0 OR (o_orderkey % 11 = 0 AND o_orderstatus IS NOT NULL)")
def changed_rows(spark, sf_dir):
    """Rows that an adapter changed: a value, a value made null; nulls on both sides are no change."""
    before = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    after = before.withColumn("o_totalprice", F.when(F.col("o_orderkey") % 10 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
    after = after.withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 11 != 0, F.col("o_orderstatus")))
    return contracts.changed_rows(before, after, ["o_orderkey"], ["o_totalprice", "o_orderstatus"])


@query("""
SELECT 0 AS step_no, 'all' AS step, count(*) AS n_rows, count(DISTINCT o_custkey) AS n_persons FROM orders
UNION ALL SELECT 1, 'open', count(*), count(DISTINCT o_custkey) FROM orders WHERE o_orderstatus = 'O'
UNION ALL SELECT 2, 'dear', count(*), count(DISTINCT o_custkey) FROM orders WHERE o_orderstatus = 'O' AND o_totalprice > 200000""")
def attrition_of_tables(spark, sf_dir):
    """The ledger of three tables, each what a step left."""
    rows = table(spark, sf_dir, "orders")
    still = rows.where("o_orderstatus = 'O'")
    return contracts.attrition([("all", rows), ("open", still), ("dear", still.where("o_totalprice > 200000"))], "o_custkey")


# projections


@query("""
WITH t AS (SELECT c_custkey, c_custkey % 6 AS m, c_name AS n FROM customer)
SELECT c_custkey, CASE m WHEN 0 THEN 'Cohort-specific eligibility criteria:' || chr(10) || n || chr(10) || chr(10) || 'Common eligibility criteria:' || chr(10) || 'adults' WHEN 1 THEN n WHEN 2 THEN 'all of ' || n WHEN 3 THEN 'whole ' || n WHEN 4 THEN 'all of ' || n ELSE 'all of ' || n END AS criteria FROM t""")
def whole_criteria(spark, sf_dir):
    """The whole criteria of a cohort: specific under headings with common ones, specific alone, extracted, original, or as they are."""
    m, n = F.col("c_custkey") % 6, F.col("c_name")
    multiple = F.when(m.isin(0, 1), "yes").when(m.isin(2, 3), "no")
    common, source = F.when(m == 0, "adults"), F.when(m == 2, "protocol").otherwise("other")
    built = text.complete_criteria(multiple, n, common, F.concat(F.lit("all of "), n), F.concat(F.lit("whole "), n), source, ["protocol"])
    return table(spark, sf_dir, "customer").select("c_custkey", built.alias("criteria"))


@query("SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'protocol' ELSE 'ctgov' END AS version FROM customer")
def version_mapping(spark, sf_dir):
    """protocol, and ctgov for whatever else or nothing."""
    return table(spark, sf_dir, "customer").select("c_custkey", text.version_of(_pick(("protocol", "ctgov", "other", None), "c_custkey")).alias("version"))


@query("SELECT o_orderkey, o_totalprice, o_orderstatus, o_custkey FROM orders")
def reconciled_tables(spark, sf_dir):
    """Two tables of one row a key whose common columns agree and are kept once."""
    rows = table(spark, sf_dir, "orders")
    return contracts.reconcile(rows.select("o_orderkey", "o_totalprice", "o_orderstatus"), rows.select("o_orderkey", "o_totalprice", "o_custkey"), ["o_orderkey"])


@query("SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN 'before' WHEN 1 THEN 'no marker here' ELSE '' END AS main, CASE doc_id % 3 WHEN 0 THEN 'after -- again' WHEN 1 THEN '' ELSE 'only after' END AS rest FROM documents")
def text_sections(spark, sf_dir):
    """A text before and after its first marker."""
    split = text.split_at_marker(_pick(("before -- after -- again", "no marker here", "-- only after")), "--")
    return table(spark, sf_dir, "documents").select("doc_id", split.alias("s")).select("doc_id", "s.main", "s.rest")


@query("SELECT doc_id, ['Adults', 'none. 2. Here', 'x 3.', '', 'A1.b'][doc_id % 5 + 1] AS plain FROM documents")
def stripped_numbering(spark, sf_dir):
    """Criteria without their numbers."""
    return table(spark, sf_dir, "documents").select("doc_id", text.strip_numbering(_pick((" 12. Adults ", "none. 2. Here", "x 3.", "7.", "A1.b"))).alias("plain"))


@query("SELECT doc_id, round((doc_id % 6) / 5.0 * 2 - 1, 9) AS score FROM documents")
def unit_range_scores(spark, sf_dir):
    """Scores of 0 to 5 as -1 to 1."""
    return table(spark, sf_dir, "documents").select("doc_id", F.round(scores.to_unit_range(F.col("doc_id") % 6, 5), 9).alias("score"))


@query("SELECT c_custkey AS patient, c_name AS line, CASE WHEN c_custkey % 3 = 0 THEN 'none' ELSE c_mktsegment END AS kind FROM customer WHERE c_custkey % 5 <> 0")
def line_item_view(spark, sf_dir):
    """Line items renamed, with defaults, without blank lines."""
    rows = table(spark, sf_dir, "customer").withColumn("c_name", F.when(F.col("c_custkey") % 5 != 0, F.col("c_name")).otherwise("  ")).withColumn("c_mktsegment", F.when(F.col("c_custkey") % 3 != 0, F.col("c_mktsegment")))
    return contracts.line_items(rows, {"c_custkey": "patient", "c_name": "line", "c_mktsegment": "kind"}, {"kind": "none"}, "line")


@query("SELECT n_nationkey, n_name AS ctgov_n_name, n_regionkey AS ctgov_n_regionkey FROM nation")
def namespaced_columns(spark, sf_dir):
    """Source columns under a prefix, the key apart."""
    return contracts.namespaced(table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey"), "ctgov_", ["n_nationkey"])


@query("SELECT l_partkey, row_number() OVER (ORDER BY first_seen, l_partkey) - 1 AS code FROM (SELECT l_partkey, min(l_orderkey) AS first_seen FROM lineitem GROUP BY l_partkey)")
def dense_codes(spark, sf_dir):
    """Codes of values in the order of their first appearance, of equal ones by value."""
    firsts = table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(F.min("l_orderkey").alias("first_seen"))
    placed = firsts.withColumn("place", F.col("first_seen") * (1 << 26) + F.col("l_partkey"))
    return windows.global_numbers(placed, "place", "number").select("l_partkey", (F.col("number") - 1).alias("code"))


# joins


@query("SELECT o_orderkey, o_custkey, c_mktsegment FROM orders JOIN customer ON c_custkey = o_custkey")
def checked_join(spark, sf_dir):
    """A join whose right side is checked to have one row a key."""
    right = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    return contracts.validated_join(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), right, ["o_custkey"])


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 250000)")
def missing_coverage(spark, sf_dir):
    """Customers without a dear order."""
    return contracts.missing_keys(table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders").where("o_totalprice > 250000").withColumnRenamed("o_custkey", "c_custkey"), ["c_custkey"])


@query("""
SELECT o.o_orderkey, count(*) AS n_before, strftime(max(r.o_orderdate), '%Y-%m-%d') AS last_day FROM orders o JOIN orders r ON r.o_custkey = o.o_custkey AND r.o_orderdate::DATE < o.o_orderdate::DATE GROUP BY o.o_orderkey""")
def reports_before_cutoff(spark, sf_dir):
    """The earlier orders of each order's customer, paired."""
    rows = table(spark, sf_dir, "orders").withColumn("day", F.to_date("o_orderdate"))
    pairs = joins.before_cutoff(rows.select("o_custkey", "day"), rows.select("o_custkey", "o_orderkey", F.col("day").alias("cutoff")), "o_custkey", "day", "cutoff")
    return pairs.groupBy("o_orderkey").agg(F.count(F.lit(1)).alias("n_before"), _day(F.max("day")).alias("last_day"))


@query("SELECT doc_id, quality AS gold, CASE WHEN doc_id % 3 <> 0 THEN toxic END AS first_model, CASE WHEN doc_id % 2 = 0 THEN 1 - toxic END AS second_model FROM (SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id)")
def aligned_outputs(spark, sf_dir):
    """Two models' answers beside the gold ones by a composite key."""
    labels = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("quality").alias("gold"), F.max("toxic").alias("toxic")).withColumn("part", F.col("doc_id") % 7)
    outputs = {"first_model": labels.where("doc_id % 3 <> 0").select("doc_id", "part", F.col("toxic").alias("answer")), "second_model": labels.where("doc_id % 2 = 0").select("doc_id", "part", (1 - F.col("toxic")).alias("answer"))}
    return scoring.aligned(labels.select("doc_id", "part", "gold"), outputs, ["doc_id", "part"], "answer", "doc_id").drop("part")


@query("SELECT doc_id, lang, source, length(lang || '/' || source)::BIGINT AS n FROM documents")
def inferred_once(spark, sf_dir):
    """A value inferred once for each distinct (language, source) and given to all rows."""
    infer = lambda distinct: distinct.withColumn("n", F.char_length(F.concat_ws("/", "lang", "source")).cast("bigint"))
    return joins.expand_distinct(table(spark, sf_dir, "documents").select("doc_id", "lang", "source"), ["lang", "source"], infer)


@query("SELECT o_orderkey, strftime(least(o_orderdate::DATE, CASE WHEN o_orderkey % 3 <> 0 THEN o_orderdate::DATE - 10 END, CASE WHEN o_orderkey % 4 = 0 THEN o_orderdate::DATE - 30 END), '%Y-%m-%d') AS first_day FROM orders")
def earliest_of_dates(spark, sf_dir):
    """The earliest of three dates in a row, nulls apart."""
    day, key = F.to_date("o_orderdate"), F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select("o_orderkey", _day(dates.earliest(day, F.when(key % 3 != 0, F.date_sub(day, 10)), F.when(key % 4 == 0, F.date_sub(day, 30)))).alias("first_day"))


# orders and lists


@query("SELECT o_custkey, o_orderkey, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS INTEGER) AS rank FROM orders QUALIFY rank <= 3")
def top_orders(spark, sf_dir):
    """The three dearest orders of each customer, ties by key."""
    return ranking.top_k(table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice"), ["o_custkey"], [F.desc("o_totalprice"), F.asc("o_orderkey")], 3).drop("o_totalprice")


@query("SELECT l_suppkey, l_orderkey, l_linenumber, CAST(row_number() OVER (PARTITION BY l_suppkey ORDER BY l_quantity DESC, l_orderkey * 10 + l_linenumber DESC) AS INTEGER) AS rank FROM lineitem QUALIFY rank <= 5")
def top_lines_reversed(spark, sf_dir):
    """The five largest lines of each supplier, of equal ones the last."""
    rows = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_quantity", (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("place"))
    return ranking.top_k_reversed(rows, ["l_suppkey"], "l_quantity", "place", 5).select("l_suppkey", "l_orderkey", "l_linenumber", "rank")


@query("SELECT l_orderkey, l_linenumber, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS INTEGER) AS original_rank FROM lineitem")
def original_ranks(spark, sf_dir):
    """The place of each line in its order's list."""
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    return ranking.top_k(rows, ["l_orderkey"], [F.asc("l_linenumber")], 1 << 30, "original_rank")


@query("SELECT o_custkey, o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1")
def first_orders(spark, sf_dir):
    """The first order of each customer."""
    rows = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return windows.first_per_key(rows, ["o_custkey"], [F.asc("o_orderdate"), F.asc("o_orderkey")]).select("o_custkey", "o_orderkey", _day("o_orderdate").alias("day"))


@query("""
WITH t AS (SELECT o_custkey, o_orderkey, row_number() OVER w AS n, floor(('0x' || substr(sha256('gap:' || o_orderkey), 1, 15))::UBIGINT::DOUBLE / 1152921504606846976.0 * 15)::INT + 7 AS gap FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey))
SELECT o_custkey, o_orderkey, strftime(DATE '2020-01-01' + (sum(CASE WHEN n = 1 THEN 0 ELSE gap END) OVER (PARTITION BY o_custkey ORDER BY o_orderkey))::INT, '%Y-%m-%d') AS day FROM t""")
def stepped_dates(spark, sf_dir):
    """Dates that go on by hash-drawn gaps of 7 to 21 days."""
    day = hashing.stepped_dates(F.lit("2020-01-01").cast("date"), 7, 21, ["o_custkey"], ["o_orderkey"], "gap", F.col("o_orderkey"))
    return table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", _day(day).alias("day"))


# sets


@query("SELECT 'customer' AS kind, c_custkey AS key, c_name AS name, c_acctbal AS balance FROM customer UNION ALL SELECT 'supplier', s_suppkey, s_name, NULL FROM supplier")
def aligned_union(spark, sf_dir):
    """Two tables of other columns, one below the other."""
    a = table(spark, sf_dir, "customer").select(F.lit("customer").alias("kind"), F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"))
    b = table(spark, sf_dir, "supplier").select(F.lit("supplier").alias("kind"), F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"))
    return a.unionByName(b, allowMissingColumns=True)


@query("""
WITH a AS (SELECT l_suppkey, l_partkey, 'quantity' AS list, rank() OVER (PARTITION BY l_suppkey ORDER BY l_quantity DESC, l_orderkey, l_linenumber) AS place FROM lineitem QUALIFY place <= 5),
b AS (SELECT l_suppkey, l_partkey, 'price' AS list, rank() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) AS place FROM lineitem QUALIFY place <= 5)
SELECT l_suppkey, l_partkey, string_agg(list || ':' || place, ',' ORDER BY list, place) AS places FROM (SELECT * FROM a UNION ALL SELECT * FROM b) GROUP BY ALL""")
def union_of_rankings(spark, sf_dir):
    """Unique pairs of two rankings, with every place of each."""
    rows = table(spark, sf_dir, "lineitem")
    order = [F.asc_nulls_last("l_orderkey"), F.asc_nulls_last("l_linenumber")]
    lists = [ranking.top_ranks(rows, ["l_suppkey"], [F.desc(c), *order], 5, "place").select("l_suppkey", "l_partkey", F.lit(name).alias("list"), "place") for name, c in (("quantity", "l_quantity"), ("price", "l_extendedprice"))]
    merged = ranking.merge_hits(lists[0].unionByName(lists[1]), ["l_suppkey", "l_partkey"], ["list", "place"])
    return merged.select("l_suppkey", "l_partkey", F.array_join(F.transform("sources", lambda s: F.concat_ws(":", s["list"], s["place"].cast("string"))), ",").alias("places"))


@query("SELECT c_custkey FROM customer WHERE c_custkey % 4 <> 0 AND c_acctbal >= 0 AND c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')")
def difference_of_sets(spark, sf_dir):
    """Eligible keys less three sets of others."""
    left = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    for gone in (left.where("c_custkey % 4 = 0"), left.where("c_acctbal < 0"), table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").withColumnRenamed("o_custkey", "c_custkey")):
        left = contracts.without(left, gone, "c_custkey")
    return left.select("c_custkey")


@query("SELECT DISTINCT s_suppkey, s_name FROM supplier")
def exact_duplicates(spark, sf_dir):
    """Exact duplicates dropped; a key with two different rows would be an error."""
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    return dedup.distinct_or_conflict(rows.unionByName(rows.where("s_suppkey % 2 = 0")), ["s_suppkey"])


@query("SELECT l_returnflag, l_linestatus, arg_min(l_orderkey, l_orderkey * 10 + l_linenumber) AS l_orderkey FROM lineitem GROUP BY ALL")
def kept_first(spark, sf_dir):
    """One row of each (flag, status): the first one."""
    rows = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", "l_orderkey", "l_linenumber")
    return windows.first_per_key(rows, ["l_returnflag", "l_linestatus"], [F.asc("l_orderkey"), F.asc("l_linenumber")]).drop("l_linenumber")


@query("SELECT lower(p_type) AS seed, count(*) AS n FROM part GROUP BY 1")
def caseless_distinct(spark, sf_dir):
    """Seeds that are the same but for case, counted together."""
    shouted = table(spark, sf_dir, "part").select(F.when(F.col("p_partkey") % 2 == 0, F.upper("p_type")).otherwise(F.col("p_type")).alias("seed"))
    return dedup.caseless(shouted, "seed")


@query("SELECT doc_id, quality FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)")
def not_yet_labelled(spark, sf_dir):
    """Rows whose keys an earlier round hasn't labelled."""
    labels = table(spark, sf_dir, "labels")
    return dedup.unlabelled(labels.select("doc_id", "quality"), labels.where("toxic = 1"), ["doc_id"])


# draws


@query("SELECT doc_id FROM labels WHERE toxic = 0 AND ('0x' || substr(sha256('audit:' || doc_id), 1, 15))::UBIGINT::DOUBLE / 1152921504606846976.0 < 0.1")
def audit_sample(spark, sf_dir):
    """A tenth of the units that aren't excluded, by hash."""
    return sampling.bernoulli(table(spark, sf_dir, "labels").where("toxic = 0"), 0.1, "audit", F.col("doc_id")).select("doc_id")


@query("""
WITH s AS (SELECT source, count(*) AS n FROM documents GROUP BY source), t AS (SELECT *, n * 64 / (SELECT sum(n) FROM s)::DOUBLE AS exact, row_number() OVER (ORDER BY source) AS i FROM s),
f AS (SELECT *, floor(exact)::BIGINT AS low, row_number() OVER (ORDER BY floor(exact) - exact, i) AS turn FROM t)
SELECT source, n AS n_rows, low + (turn <= 64 - (SELECT sum(low) FROM f))::BIGINT AS shards FROM f""")
def shards_by_size(spark, sf_dir):
    """64 shards shared out to sources by their sizes, the rest to the largest remainders."""
    sizes = table(spark, sf_dir, "documents").groupBy("source").agg(F.count(F.lit(1)).alias("n")).orderBy("source").collect()  # a row a source
    shares = sampling.largest_remainder([r["n"] for r in sizes], 64)
    return spark.createDataFrame([(r["source"], r["n"], s) for r, s in zip(sizes, shares, strict=True)], "source string, n_rows bigint, shards bigint")


@query("SELECT i AS shard, i * (n // 7) + least(i, n % 7) AS first, (i + 1) * (n // 7) + least(i + 1, n % 7) AS beyond FROM (SELECT count(*) AS n FROM orders), (SELECT unnest(range(7)) AS i)")
def contiguous_shards(spark, sf_dir):
    """Seven ranges of rows whose lengths differ by one at most."""
    found = sampling.contiguous_ranges(table(spark, sf_dir, "orders").count(), 7)
    return spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(found)], "shard bigint, first bigint, beyond bigint")


@query("SELECT l_suppkey * 1000003 + l_partkey AS pair, count(*) AS n FROM lineitem WHERE (l_suppkey, l_partkey) IN (SELECT (l_suppkey, l_partkey) FROM lineitem WHERE l_returnflag = 'R') GROUP BY 1")
def known_pairs(spark, sf_dir):
    """Pairs as one key, and those of them that are known positives."""
    known = F.bool_or(F.coalesce(F.col("l_returnflag") == "R", F.lit(False)))  # of the pair itself: two pairs may have one key
    pairs = table(spark, sf_dir, "lineitem").groupBy("l_suppkey", "l_partkey").agg(F.count(F.lit(1)).alias("n"), known.alias("known"))
    return pairs.where("known").groupBy((F.col("l_suppkey") * 1000003 + F.col("l_partkey")).alias("pair")).agg(F.sum("n").alias("n"))


@query("SELECT doc_id, 10 * doc_id + CAST(row_number() OVER (PARTITION BY source ORDER BY doc_id) % 10 AS BIGINT) + 1 AS derived, substr(sha256('id:' || doc_id), 1, 16) AS pair_key FROM documents")
def derived_ids(spark, sf_dir):
    """Ids derived from a number and a place, and 64-bit keys of a hash."""
    from pyspark.sql import Window

    place = F.row_number().over(Window.partitionBy("source").orderBy("doc_id")) % 10
    return table(spark, sf_dir, "documents").select("doc_id", (10 * F.col("doc_id") + place + 1).alias("derived"), F.lower(F.lpad(F.hex(F.conv(hashing.pair_hash("id", F.col("doc_id")).cast("string"), 10, -10).cast("bigint")), 16, "0")).alias("pair_key"))


# parsers


_SUMMARY = "Age: 50\nSex: male. Smoker\nTreatment history: First line. Second line; Third\n\nBiomarkers:\nEGFR positive! ALK negative"


@query("""
WITH s(n, section, text) AS (VALUES (1, 'Age', 'Age: 50'), (2, 'Sex', 'Sex: male.'), (3, 'Sex', 'Smoker'), (4, 'Treatment history', 'First line.'), (5, 'Treatment history', 'Second line;'), (6, 'Treatment history', 'Third'), (7, 'Biomarkers', 'EGFR positive!'), (8, 'Biomarkers', 'ALK negative'))
SELECT c_custkey, CAST(n AS INTEGER) AS n, section, text FROM customer, s WHERE c_custkey % 2 = 0""")
def summary_statements(spark, sf_dir):
    """The numbered statements of summaries under their headings; every other summary is empty."""
    rows = table(spark, sf_dir, "customer").select("c_custkey", F.when(F.col("c_custkey") % 2 == 0, F.lit(_SUMMARY)).otherwise("").alias("summary"))
    return histories.statements(rows, "c_custkey", "summary")


@query("SELECT c_custkey, CAST(n AS INTEGER) AS number, kind, text FROM customer, (VALUES (1, 'note', 'seen a < b'), (2, 'scan', 'clear'), (3, 'note', '')) AS e(n, kind, text)")
def tagged_events(spark, sf_dir):
    """Events of known kinds from a tagged text."""
    events = text.tagged_events(F.lit("intro <note> seen a < b <scan>clear <note>"), ["note", "scan"])
    return table(spark, sf_dir, "customer").select("c_custkey", F.explode(events).alias("e")).select("c_custkey", "e.number", "e.kind", "e.text")


@query("SELECT user_id, event_type, regexp_replace(props, '[0-9]+', '#', 'g') AS shape, count(*) AS n FROM events GROUP BY ALL")
def masked_digits(spark, sf_dir):
    """Log lines by their shape, runs of digits masked."""
    return table(spark, sf_dir, "events").select("user_id", "event_type", text.mask_digits(F.col("props")).alias("shape")).groupBy("user_id", "event_type", "shape").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT event_id, CASE WHEN event_id % 3 <> 2 THEN CAST(json_extract(props, '$.k') AS INT) END AS k, event_id % 3 <> 2 AS valid FROM events")
def fenced_answers(spark, sf_dir):
    """JSON answers with and without a code fence, and broken ones."""
    props = F.col("props")
    answer = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("```json\n"), props, F.lit("\n```"))).when(F.col("event_id") % 3 == 1, props).otherwise(F.concat(F.lit("sorry: "), props))
    k = F.from_json(text.strip_fence(answer), "k int")["k"]
    return table(spark, sf_dir, "events").select("event_id", k.alias("k"), k.isNotNull().alias("valid"))


@query("SELECT doc_id, ['yes', 'no', 'unknown', 'unknown', 'yes'][doc_id % 5 + 1] AS value, ['no', 'yes', 'unknown', 'unknown', 'no'][doc_id % 5 + 1] AS inverted FROM documents")
def collapsed_values(spark, sf_dir):
    """Values collapsed by a map, and their opposite."""
    folds, opposite = {"present": "yes", "positive": "yes", "absent": "no"}, {"yes": "no", "no": "yes"}
    fold = lambda c, m, other: F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for kv in m.items() for x in kv)), c), F.lit(other))
    value = fold(_pick(("present", "absent", "maybe", None, "positive")), folds, "unknown")
    return table(spark, sf_dir, "documents").select("doc_id", value.alias("value"), fold(value, opposite, "unknown").alias("inverted"))


@query("SELECT doc_id, kind, value, CASE WHEN kind = 'drug' THEN 'line ' || (doc_id % 3) END AS detail FROM documents, (VALUES ('site', 'lung'), ('drug', 'a'), ('drug', 'b')) AS u(kind, value) WHERE doc_id % 2 = 0 OR kind = 'site'")
def answer_units(spark, sf_dir):
    """One answer as many units of (kind, value, detail)."""
    detail = F.concat(F.lit("line "), (F.col("doc_id") % 3).cast("string"))
    drugs = F.when(F.col("doc_id") % 2 == 0, F.array(F.lit("a"), F.lit("b"))).otherwise(F.array().cast("array<string>"))
    units = F.concat(F.array(F.struct(F.lit("site").alias("kind"), F.lit("lung").alias("value"), F.lit(None).cast("string").alias("detail"))), F.transform(drugs, lambda d: F.struct(F.lit("drug").alias("kind"), d.alias("value"), detail.alias("detail"))))
    return table(spark, sf_dir, "documents").select("doc_id", F.inline(units))


@query("SELECT doc_id, ['White', 'Asian', 'Other', 'Unknown', 'Black'][doc_id % 5 + 1] AS category FROM documents")
def cleaned_categories(spark, sf_dir):
    """Categories: trimmed, by prefix, from a fallback, outside the allowed ones, unknown."""
    value, fallback = _pick((" white ", "ASIAN indian", "martian", "", None)), _pick((None, None, None, None, "black"))
    return table(spark, sf_dir, "documents").select("doc_id", text.category(value, ["White", "Asian", "Black"], {"Asian": "Asian"}, fallback).alias("category"))


_SEEDS = ("Diagnosed at age 50 years and 3 weeks. Started therapy at 51 years and 0 weeks.", "At 40 years and 2 weeks diagnosed with it; relapse at 2 years and 0 weeks.", "Treated at age 33 years and 51 weeks, progressed at age of 30 years and 1 week", "no age here", "Diagnosed at 50.5 years and 3 weeks")


@query(f"""
SELECT doc_id, {_sql_list(("50+3", "40+2", "", None, None))}[doc_id % 5 + 1] AS diagnoses, {_sql_list(("51+0", "", "30+1,33+51", None, None))}[doc_id % 5 + 1] AS others, [0, 1, 0, NULL, NULL][doc_id % 5 + 1]::INT AS intervals, doc_id % 5 >= 3 AS failed FROM documents""")
def age_anchors(spark, sf_dir):
    """Ages that seeds tie to a diagnosis or to something else, and seeds without whole ages."""
    found = table(spark, sf_dir, "documents").select("doc_id", seeds.anchors(_pick(_SEEDS)).alias("a"))
    return found.select("doc_id", F.array_join("a.diagnoses", ",").alias("diagnoses"), F.array_join("a.others", ",").alias("others"), "a.intervals", F.col("a.error").isNotNull().alias("failed"))


_NOTES = ("On protocol #17-123, drug ABC-1234 (NCT01234567).", "17–123 and 18-999; NCT 01234567x", "see 17_123, abc 1234 and ABC.1234", "nothing here, 2017-1234", None)
_MASKED = ("On [TRIAL PROTOCOL], drug [STUDY DRUG CODE] ([NCT ID]).", "[TRIAL PROTOCOL] and 18-999; [NCT ID]x", "see 17_123, [STUDY DRUG CODE] and ABC.1234", "nothing here, 2017-1234", None)


@query(f"""
SELECT doc_id, {_sql_list(_MASKED)}[doc_id % 5 + 1] AS masked, [1, 1, 0, 0, 0][doc_id % 5 + 1]::INT AS n_protocol, [1, 1, 0, 0, 0][doc_id % 5 + 1]::INT AS n_nct, [1, 0, 1, 0, 0][doc_id % 5 + 1]::INT AS n_code,
  ['', '', 'protocol_other_separator,code_other_separator', '', ''][doc_id % 5 + 1] AS residual FROM documents""")
def masked_notes(spark, sf_dir):
    """Notes of known identifiers masked, how many of each kind, and the checks that still find one."""
    found = masking.masked(_pick(_NOTES), F.array(F.lit(17123)), F.array(F.lit("1234567")), F.array(F.lit("ABC1234")))
    return table(spark, sf_dir, "documents").select("doc_id", found.alias("m")).select("doc_id", F.col("m.text").alias("masked"), "m.n_protocol", "m.n_nct", "m.n_code", F.array_join("m.residual", ",").alias("residual"))


@query("SELECT doc_id, ['ABC1234,XY123A', 'ABC1234', '', ''][doc_id % 4 + 1] AS codes FROM documents")
def codes_in_titles(spark, sf_dir):
    """Drug codes in titles, without registry ids and names of markers."""
    titles = ("XY-123A plus ABC 1234 and ABC-1234", "ABC1234 in COVID19 and CD123", "NCT 01234567 alone", None)
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(text.title_codes(_pick(titles)), ",").alias("codes"))


# scorers, folds, stages


@query("SELECT doc_id, CASE WHEN length(text) % 7 <> 0 THEN length(text)::INT % 5 END AS score, length(text) % 7 = 0 AS failed FROM documents WHERE text IS NOT NULL")
def scored_texts(spark, sf_dir):
    """A scorer called in batches on distinct texts; rows without a valid answer fail after three attempts."""
    def scorer(rows):
        return [None if len(t) % 7 == 0 else len(t) % 5 for t in rows["text"]]

    rows = table(spark, sf_dir, "documents").where("text IS NOT NULL").select("doc_id", "text")
    return scoring.scored(rows, ["text"], scorer, "score", "int").select("doc_id", "score", F.col("score_error").isNotNull().alias("failed"))


@query("SELECT item_id, length(text)::BIGINT AS n_chars, true AS unit, round(length(text) / sqrt(length(text) ** 2 + 1), 5) AS first FROM benchmark")
def encoded_texts(spark, sf_dir):
    """Unit vectors from an encoder, exported and read back."""
    import numpy as np

    rows = scoring.encoded(table(spark, sf_dir, "benchmark"), "text", lambda texts: np.array([[len(t), 1.0] for t in texts]))
    path = writers.publish(rows.select("item_id", F.char_length("text").cast("bigint").alias("n_chars"), "vector"), shared.written_path(spark, "vectors") + ".parquet")
    norm = F.aggregate("vector", F.lit(0.0), lambda s, v: s + v.cast("double") * v.cast("double"))
    return spark.read.parquet(path).select("item_id", "n_chars", (F.abs(norm - 1) < 1e-5).alias("unit"), F.round(F.col("vector")[0].cast("double"), 5).alias("first"))


@query("SELECT item_id, len(list_filter(regexp_split_to_array(text, '[ \\t\\n\\r]+'), lambda x: x <> ''))::INT AS n_tokens FROM benchmark")
def tokenized_texts(spark, sf_dir):
    """Token counts from a tokenizer that is a parameter; here white space cuts."""
    rows = scoring.scored(table(spark, sf_dir, "benchmark").select("item_id", "text"), ["text"], lambda batch: [len(t.split()) for t in batch["text"]], "n_tokens", "int")
    return rows.select("item_id", "n_tokens")


@query("""
WITH u AS (SELECT o_custkey, sum(o_totalprice) AS s, count(o_totalprice) AS c, row_number() OVER (ORDER BY o_custkey) - 1 AS number FROM orders GROUP BY o_custkey),
n AS (SELECT count(*) AS n FROM u), picks AS (SELECT draw, ('0x' || substr(sha256('any:' || draw || ':' || pick), 1, 8))::UBIGINT % n AS number FROM range(50) a(draw), n, LATERAL (SELECT unnest(range(n)) AS pick)),
m AS (SELECT draw, sum(s) / sum(c) AS mean FROM picks JOIN u USING (number) GROUP BY draw)
SELECT (SELECT n FROM n) AS n_units, count(*) AS draws, round(quantile_cont(mean, 0.025), 2) AS low, round(quantile_cont(mean, 0.5), 2) AS middle, round(quantile_cont(mean, 0.975), 2) AS high FROM m""")
def bootstrap_of_metric(spark, sf_dir):
    """A percentile interval of a metric that is a parameter, here a weighted mean by draw."""
    def mean(drawn):
        return drawn.groupBy("draw").agg(F.try_divide(F.sum(F.col("weight") * F.col("o_totalprice")), F.sum("weight")).alias("value"))

    found = metrics.bootstrap_metric(table(spark, sf_dir, "orders"), "o_custkey", mean, 50, "any")
    return found.select("n_units", "draws", *(F.round(c, 2).alias(c) for c in ("low", "middle", "high")))


@query("""
SELECT 'reply' AS task, conv_id || '/' || turn AS id, min(text) AS prompt, min(role) AS answer FROM conversations WHERE text IS NOT NULL GROUP BY ALL
UNION ALL SELECT 'toxic', d.doc_id::VARCHAR, d.source, CASE WHEN l.toxic = 1 THEN 'yes' ELSE 'no' END FROM documents d JOIN (SELECT doc_id, max(toxic) AS toxic FROM labels GROUP BY doc_id) l USING (doc_id) WHERE d.source IS NOT NULL""")
def task_examples(spark, sf_dir):
    """Examples of two tasks by their adapters."""
    labels = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    tables = {"reply": table(spark, sf_dir, "conversations"), "toxic": table(spark, sf_dir, "documents").join(labels, "doc_id")}
    made = {
        "reply": adapters.adapter(F.concat_ws("/", F.col("conv_id").cast("string"), F.col("turn").cast("string")), F.col("text"), F.col("role")),
        "toxic": adapters.adapter(F.col("doc_id"), F.col("source"), F.when(F.col("toxic") == 1, "yes").otherwise("no")),
    }
    return adapters.examples(made, tables)


@query("SELECT conv_id, string_agg(turn || ':' || length(text), ' ' ORDER BY turn) AS summary, count(*) AS n_rounds FROM conversations WHERE text IS NOT NULL GROUP BY conv_id")
def folded_conversations(spark, sf_dir):
    """Each conversation's turns folded in order, one state after the other."""
    rows = table(spark, sf_dir, "conversations").where("text IS NOT NULL").select("conv_id", "turn", F.concat(F.col("turn").cast("string"), F.lit(":"), F.char_length("text").cast("string")).alias("piece"))
    return histories.fold_rounds(rows, "conv_id", "turn", lambda state, piece: piece if state is None else f"{state} {piece}", "piece")


@query("SELECT name, n_rows::BIGINT AS n_rows, first, again, later FROM (SELECT 'open' AS name, (SELECT count(*) FROM orders WHERE o_orderstatus = 'O') AS n_rows, true AS first, false AS again, 20 AS later UNION ALL SELECT 'customers', (SELECT count(DISTINCT o_custkey) FROM orders WHERE o_orderstatus = 'O'), true, false, 0)")
def stage_receipts(spark, sf_dir):
    """Two stages run once, left alone the second time, and found out when a setting changes."""
    orders = table(spark, sf_dir, "orders")
    first = stages.Stage("open", lambda s, t: orders.where("o_orderstatus = 'O'"), settings={"status": "O"})
    second = stages.Stage("customers", lambda s, t: t["open"].select("o_custkey").distinct(), ["open"])
    runner = stages.Runner(spark, shared.written_path(spark, "stages"))
    ran, again = runner.run(stages.select_range([first, second], "open", "customers")), runner.run([first, second])
    changed = stages.Stage("open", first.run, settings={"status": "F"})
    later = {"open": runner.check(changed)[0], "customers": runner.check(second)[0]}
    rows = [(s.name, runner.table(s.name).count(), s.name in ran, s.name in again, later[s.name]) for s in (first, second)]
    return spark.createDataFrame(rows, "name string, n_rows bigint, first boolean, again boolean, later int")


@query()
def micro_batches(spark, sf_dir):
    """Documents in batches whose padded size stays within a budget. (No SQL: batches are cut one after another; tests hold it against brute force.)"""
    return sampling.micro_batches(table(spark, sf_dir, "documents"), "doc_id", "n_chars", 200_000, 4096, 5)
