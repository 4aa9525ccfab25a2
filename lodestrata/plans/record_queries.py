"""Populations, time and contracts over the order, event and line tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import dates, hashing
from ..operators import contracts, dedup, joins, journal, sampling, windows
from .registry import query, table


def _orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").withColumn("day", F.to_date("o_orderdate"))


def _lines(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").withColumn("ship_day", F.to_date("l_shipdate"))


def _text(day):
    return F.date_format(day, "yyyy-MM-dd")


@query("SELECT CAST(o_custkey AS BIGINT) AS o_custkey, strftime(o_orderdate, '%Y-%m-%d') AS day, row_number() OVER (ORDER BY o_orderdate::DATE, o_custkey) AS event_no FROM (SELECT DISTINCT o_custkey, o_orderdate::DATE AS o_orderdate FROM orders)")
def index_event_ids(spark, sf_dir):
    """Sequence numbers of distinct (customer, day) by day, then customer, numbered range by range."""
    events = _orders(spark, sf_dir).select("o_custkey", "day").distinct()
    keyed = events.withColumn("place", F.unix_date("day").cast("long") * F.lit(1 << 40) + F.col("o_custkey"))
    return windows.global_numbers(keyed, "place", "event_no").select("o_custkey", _text("day").alias("day"), "event_no")


@query("""
WITH j AS (SELECT o.*, c.c_acctbal, n.n_regionkey FROM orders o LEFT JOIN customer c ON c_custkey = o_custkey LEFT JOIN nation n ON n_nationkey = c_nationkey),
f AS (SELECT *, true AS f0, coalesce(o_orderstatus <> 'P', false) AS f1, coalesce(year(o_orderdate) >= 1997, false) AS f2, coalesce(c_acctbal > 0, false) AS f3, coalesce(n_regionkey IN (1, 2), false) AS f4 FROM j)
SELECT 0 AS step_no, 'all orders' AS step, count(*) AS n_rows, count(DISTINCT o_custkey) AS n_persons FROM f
UNION ALL SELECT 1, 'not pending', count(*), count(DISTINCT o_custkey) FROM f WHERE f1
UNION ALL SELECT 2, 'from 1997', count(*), count(DISTINCT o_custkey) FROM f WHERE f1 AND f2
UNION ALL SELECT 3, 'positive balance', count(*), count(DISTINCT o_custkey) FROM f WHERE f1 AND f2 AND f3
UNION ALL SELECT 4, 'two regions', count(*), count(DISTINCT o_custkey) FROM f WHERE f1 AND f2 AND f3 AND f4""")
def attrition_ledger(spark, sf_dir):
    """Rows and persons after each of five filters, in one pass."""
    customers = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
    rows = table(spark, sf_dir, "orders").join(customers, F.col("o_custkey") == F.col("c_custkey"), "left")
    flags = [("all orders", F.lit(True)), ("not pending", F.col("o_orderstatus") != "P"), ("from 1997", F.year("o_orderdate") >= 1997), ("positive balance", F.col("c_acctbal") > 0), ("two regions", F.col("n_regionkey").isin(1, 2))]
    return contracts.attrition_by_flags(rows, "o_custkey", flags)


@query("""
SELECT o_custkey, l_suppkey, strftime(min(l_shipdate), '%Y-%m-%d') AS first_day, arg_min(o_orderkey * 10 + l_linenumber, (l_shipdate, o_orderkey, l_linenumber)) AS first_line, count(*) AS n_lines
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL""")
def first_start_per_key(spark, sf_dir):
    """The first shipment of each customer and supplier."""
    rows = _lines(spark, sf_dir).join(_orders(spark, sf_dir), F.col("l_orderkey") == F.col("o_orderkey"))
    line = F.col("o_orderkey") * 10 + F.col("l_linenumber")
    facts = rows.groupBy("o_custkey", "l_suppkey").agg(F.min_by(F.struct("ship_day", line.alias("line")), F.struct("ship_day", "o_orderkey", "l_linenumber")).alias("first"), F.count(F.lit(1)).alias("n_lines"))
    return facts.select("o_custkey", "l_suppkey", _text("first.ship_day").alias("first_day"), F.col("first.line").alias("first_line"), "n_lines")


@query("""
WITH a AS (SELECT o_orderkey, o_custkey, o_orderdate::DATE AS d FROM orders WHERE o_orderstatus = 'O'),
b AS (SELECT o_custkey, o_orderkey AS other_key, o_orderdate::DATE AS other_d FROM orders WHERE o_orderstatus = 'F')
SELECT o_orderkey, o_custkey, other_key, CAST(other_d - d AS INTEGER) AS gap_days FROM a JOIN b USING (o_custkey) WHERE other_d - d BETWEEN -14 AND 90
QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY abs(other_d - d), other_d, other_key) = 1""")
def nearest_masked_event(spark, sf_dir):
    """For each open order the customer's finished one within -14 to 90 days, nearest first."""
    orders = _orders(spark, sf_dir)
    left = orders.where("o_orderstatus = 'O'").select("o_orderkey", "o_custkey", "day")
    right = orders.where("o_orderstatus = 'F'").groupBy("o_custkey", F.col("day").alias("other_day")).agg(F.min("o_orderkey").alias("other_key"))
    return joins.nearest_in_band(left, right, ["o_custkey"], "day", "other_day", -14, 90, ["o_orderkey"]).select("o_orderkey", "o_custkey", "other_key", "gap_days")


@query("""
WITH r AS (SELECT o_custkey, l_shipdate::DATE AS d FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT o.o_orderkey, count(r.d) AS n_prior FROM orders o LEFT JOIN r ON r.o_custkey = o.o_custkey AND r.d < o.o_orderdate::DATE GROUP BY o.o_orderkey""")
def prior_count_cutoff(spark, sf_dir):
    """Shipments of the customer strictly before each order."""
    orders = _orders(spark, sf_dir)
    reports = _lines(spark, sf_dir).join(orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey")).select("o_custkey", "ship_day")
    return joins.prior_counts(orders.select("o_orderkey", "o_custkey", "day"), reports, "o_custkey", "day", "ship_day").select("o_orderkey", "n_prior")


_WINDOWS = """
WITH w AS (SELECT l_suppkey, min(l_shipdate)::DATE AS opened, CASE WHEN bool_or(l_returnflag = 'R' AND l_linenumber = 7) THEN NULL ELSE max(l_shipdate)::DATE END AS closed FROM lineitem GROUP BY l_suppkey)
"""


def _supplier_windows(spark, sf_dir):
    rows = _lines(spark, sf_dir)
    end = F.when(F.bool_or((F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 7)), F.lit(None)).otherwise(F.max("ship_day"))
    return rows.groupBy("l_suppkey").agg(F.min("ship_day").alias("opened"), end.alias("closed"))


@query(_WINDOWS + "SELECT l_suppkey, strftime(opened, '%Y-%m-%d') AS opened, strftime(closed, '%Y-%m-%d') AS closed, count(o_orderkey) AS n_open FROM w LEFT JOIN orders ON coalesce(opened <= o_orderdate::DATE, true) AND coalesce(o_orderdate::DATE <= closed, true) GROUP BY ALL")
def temporal_open_window(spark, sf_dir):
    """Orders dated within each supplier's window; an open end never closes. Days are counted first, and spans read off running totals."""
    days = _orders(spark, sf_dir).groupBy("day").agg(F.count(F.lit(1)).alias("n"))
    met = joins.open_counts(_supplier_windows(spark, sf_dir), days, "opened", "closed", "day", "n", "n_open")
    return met.select("l_suppkey", _text("opened").alias("opened"), _text("closed").alias("closed"), "n_open")


@query(_WINDOWS + """SELECT o_orderkey, l_suppkey, CASE WHEN opened IS NULL OR closed IS NULL THEN NULL ELSE o_orderdate::DATE BETWEEN opened AND closed END AS in_window
FROM orders JOIN w ON w.l_suppkey = o_custkey % 100""")
def window_flags(spark, sf_dir):
    """Three-valued: whether an order falls into its supplier's window, null if the window's end is unknown."""
    orders = _orders(spark, sf_dir).withColumn("l_suppkey", F.col("o_custkey") % 100)
    return orders.join(_supplier_windows(spark, sf_dir), "l_suppkey").select("o_orderkey", "l_suppkey", joins.window_flag(F.col("day"), F.col("opened"), F.col("closed")).alias("in_window"))


@query("""
SELECT l_suppkey, count(*) AS n_rows, count(DISTINCT l_partkey) AS n_parts, string_agg(DISTINCT l_returnflag, ';' ORDER BY l_returnflag) AS flags,
  strftime(min(l_shipdate), '%Y-%m-%d') AS first_day, CASE WHEN bool_or(l_tax = 0 AND l_discount = 0) THEN NULL ELSE strftime(max(l_shipdate), '%Y-%m-%d') END AS last_day
FROM lineitem GROUP BY l_suppkey""")
def trial_window_table(spark, sf_dir):
    """Counts, distinct counts, a sorted set and a window with an open end for each supplier."""
    rows = _lines(spark, sf_dir)
    end = F.when((F.col("l_tax") != 0) | (F.col("l_discount") != 0), F.col("ship_day"))
    return rows.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("l_partkey").alias("n_parts"), dedup.sorted_join(F.col("l_returnflag")).alias("flags"), _text(F.min("ship_day")).alias("first_day"), _text(dates.latest_unless_open(end)).alias("last_day"))


@query("""
SELECT c AS cutoff_days, event_type, count(*) FILTER (WHERE age < c) AS n_events, count(DISTINCT user_id) FILTER (WHERE age < c) AS n_users
FROM (SELECT *, date_diff('day', DATE '2024-01-01', ts::DATE) AS age FROM events), (SELECT unnest([1, 7, 14, 28]) AS c) GROUP BY ALL""")
def leakage_cutoffs(spark, sf_dir):
    """Events and users before each of four cutoffs, by type."""
    age = F.datediff(F.to_date("ts"), F.lit("2024-01-01").cast("date"))
    rows = table(spark, sf_dir, "events").withColumn("age", age)
    cells = F.array(*(F.struct(F.lit(c).alias("cutoff_days"), F.count_if(F.col("age") < c).alias("n_events"), F.countDistinct(F.when(F.col("age") < c, F.col("user_id"))).alias("n_users")) for c in (1, 7, 14, 28)))
    return rows.groupBy("event_type").agg(cells.alias("cells")).select("event_type", F.inline("cells"))


@query("""
SELECT CASE WHEN d < 7 THEN '0-6' WHEN d < 14 THEN '7-13' WHEN d < 30 THEN '14-29' END AS bin, count(*) AS n FROM (SELECT date_diff('day', DATE '2024-01-01', ts::DATE) AS d FROM events) GROUP BY 1""")
def day_bins(spark, sf_dir):
    """Events by days since the first of the month, bins closed on the left."""
    age = F.datediff(F.to_date("ts"), F.lit("2024-01-01").cast("date"))
    return table(spark, sf_dir, "events").groupBy(dates.day_bin(age, [0, 7, 14, 30], ["0-6", "7-13", "14-29"]).alias("bin")).agg(F.count(F.lit(1)).alias("n"))


@query("""
WITH h AS (SELECT o_orderkey, o_custkey, sha256('7:match:' || o_custkey || ':' || o_orderkey) AS d, sha256(o_custkey || ':' || o_orderkey) AS p FROM orders)
SELECT o_orderkey, CAST(('0x' || substr(d, 1, 8))::UBIGINT % 100 AS INTEGER) AS part, ('0x' || substr(p, 1, 16))::UBIGINT::VARCHAR AS pair_key,
  ('0x' || substr(d, 1, 15))::UBIGINT::DOUBLE / 1152921504606846976.0 < 0.25 AS drawn FROM h""")
def portfolio_partition(spark, sf_dir):
    """A fixed partition, a 64-bit pair key and a Bernoulli draw of each order."""
    key = ("7", "match", F.col("o_custkey"), F.col("o_orderkey"))
    return table(spark, sf_dir, "orders").select("o_orderkey", hashing.hash_partition(100, *key).alias("part"), hashing.pair_hash(F.col("o_custkey"), F.col("o_orderkey")).cast("string").alias("pair_key"), (hashing.hash_fraction(*key) < 0.25).alias("drawn"))


@query("""
SELECT split, count(*) AS n FROM (SELECT CASE WHEN u < 0.8 THEN 'train' WHEN u < 0.9 THEN 'val' ELSE 'test' END AS split FROM
 (SELECT ('0x' || substr(sha256('split:' || c_custkey), 1, 15))::UBIGINT::DOUBLE / 1152921504606846976.0 AS u FROM customer)) GROUP BY split""")
def hash_split(spark, sf_dir):
    """Customers split 80/10/10 by hash."""
    return table(spark, sf_dir, "customer").groupBy(hashing.split_of(hashing.hash_fraction("split", F.col("c_custkey"))).alias("split")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT c_custkey FROM customer ORDER BY sha256('3:' || c_custkey), c_custkey LIMIT 50")
def sample_exact_n(spark, sf_dir):
    """Exactly fifty customers in hash order."""
    return sampling.sample_ids(table(spark, sf_dir, "customer"), "c_custkey", 50, 3)


@query("""
SELECT o_custkey, o_orderpriority, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY sha256('11:' || o_custkey || ':' || o_orderpriority), o_orderpriority) AS INTEGER) AS draw
FROM (SELECT DISTINCT o_custkey, o_orderpriority FROM orders) QUALIFY draw <= 2""")
def portfolio_per_person(spark, sf_dir):
    """Two order priorities drawn for each customer."""
    return sampling.portfolio(table(spark, sf_dir, "orders"), "o_custkey", "o_orderpriority", 2, 11)


@query("""
WITH s AS (SELECT lang, count(*) AS n FROM documents GROUP BY lang),
deal AS (SELECT lang, n, i, row_number() OVER (ORDER BY i, lang) AS k FROM s, range(60) t(i) WHERE i < n),
take AS (SELECT lang, any_value(n) AS n, count(*) AS take FROM deal WHERE k <= 60 GROUP BY lang),
drawn AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY sha256('5:' || doc_id), doc_id) AS draw FROM documents)
SELECT doc_id, lang, n / take AS weight FROM drawn JOIN take USING (lang) WHERE draw <= take""")
def stratified_sample_weights(spark, sf_dir):
    """Sixty documents dealt over languages, with inverse-probability weights."""
    return sampling.weighted_sample(table(spark, sf_dir, "documents").select("doc_id", "lang"), "lang", "doc_id", 60, 5)


@query("""
SELECT doc_id, source, n_chars FROM (SELECT *, coalesce(sum(n_chars) OVER (PARTITION BY source ORDER BY sha256('9:' || doc_id), doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM documents) WHERE before < 5000""")
def quota_sample(spark, sf_dir):
    """Documents of each source in hash order up to 5000 characters."""
    return sampling.to_quota(table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars"), ["source"], "doc_id", "n_chars", 5000, 9)


@query("""
WITH v AS (SELECT p_brand, list_sort(list(DISTINCT p_type)) AS versions FROM part GROUP BY p_brand),
c AS (SELECT p_brand, versions[1 + (('0x' || substr(sha256('2:' || p_brand), 1, 8))::UBIGINT % len(versions))::BIGINT] AS p_type FROM v)
SELECT p_partkey, p_brand, p_type FROM part JOIN c USING (p_brand, p_type)""")
def version_choice(spark, sf_dir):
    """One type of each brand by hash, with its parts."""
    return sampling.choose_version(table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type"), "p_brand", "p_type", 2)


@query("SELECT lang, source, min(doc_id) AS doc_id, count(*) AS n_rows FROM documents WHERE trim(lang) <> '' AND trim(source) <> '' AND (lang, source) NOT IN (SELECT lang, source FROM documents JOIN labels USING (doc_id) WHERE toxic = 1) GROUP BY lang, source")
def unique_combinations(spark, sf_dir):
    """Combinations of language and source not yet seen, with a representative and their number."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    return dedup.unique_combinations(docs, ["lang", "source"], ["doc_id"], docs.join(table(spark, sf_dir, "labels").where("toxic = 1"), "doc_id", "left_semi").select("lang", "source").distinct())


@query("""
WITH r AS (SELECT *, row_number() OVER (PARTITION BY user_id, props ORDER BY ts DESC, event_id DESC) AS k FROM events)
SELECT user_id, props, event_id, event_type FROM r WHERE k = 1 AND event_type <> 'error'""")
def latest_wins_retract(spark, sf_dir):
    """The latest event of each user and property; an error withdraws it."""
    rows = table(spark, sf_dir, "events").select("user_id", "props", "ts", "event_id", "event_type")
    return journal.current_entries(rows, ["user_id", "props"], ["ts", "event_id"], "event_type", "error").select("user_id", "props", "event_id", "event_type")


@query("""
WITH r AS (SELECT user_id, json_extract(props, '$.k')::INT AS k, event_type, event_id // 1000 AS round, event_id FROM events)
SELECT user_id, k, arg_max(event_type, (round, event_id)) AS event_type, count(DISTINCT event_type) > 1 AS conflict, max(round) AS round FROM r GROUP BY user_id, k""")
def label_conflict_resolve(spark, sf_dir):
    """The last round's value of each key, and whether rounds disagreed."""
    k = F.get_json_object("props", "$.k").cast("int")
    rows = table(spark, sf_dir, "events").select("user_id", k.alias("k"), "event_type", F.struct(F.floor(F.col("event_id") / 1000).cast("long").alias("round"), "event_id").alias("at"))
    return dedup.resolve_rounds(rows, ["user_id", "k"], "event_type", "at").withColumn("round", F.col("at.round")).drop("at")


@query("""
WITH r AS (SELECT user_id, json_extract(props, '$.k')::INT AS k, event_id // 1000 AS round, event_id FROM events), f AS (SELECT user_id, k, min(round) AS round FROM r GROUP BY user_id, k)
SELECT user_id, k, round, event_id FROM r JOIN f USING (user_id, k, round)""")
def earliest_round_only(spark, sf_dir):
    """Events of the first round of their key."""
    rows = table(spark, sf_dir, "events").select("user_id", F.get_json_object("props", "$.k").cast("int").alias("k"), F.floor(F.col("event_id") / 1000).cast("long").alias("round"), "event_id")
    return dedup.earliest_round(rows, ["user_id", "k"], "round").select("user_id", "k", "round", "event_id")


@query("""
WITH e AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n, CASE WHEN event_id % 3 = 0 THEN value END AS v FROM events WHERE value IS NOT NULL),
f AS (SELECT *, last_value(v IGNORE NULLS) OVER b AS v0, last_value(CASE WHEN v IS NOT NULL THEN n END IGNORE NULLS) OVER b AS x0, first_value(v IGNORE NULLS) OVER a AS v1, first_value(CASE WHEN v IS NOT NULL THEN n END IGNORE NULLS) OVER a AS x1 FROM e
  WINDOW b AS (PARTITION BY user_id ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), a AS (PARTITION BY user_id ORDER BY n ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
i AS (SELECT user_id, event_id, n, CASE WHEN v0 IS NULL THEN v1 WHEN v1 IS NULL OR x1 = x0 THEN v0 ELSE v0 + (v1 - v0) * (n - x0) / (x1 - x0) END AS x FROM f),
o AS (SELECT *, CAST(floor(x * 10) AS BIGINT) AS o FROM i)
SELECT user_id, event_id, x AS value, max(o - n) OVER (PARTITION BY user_id ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) + n AS day_offset FROM o""")
def fabricated_dates(spark, sf_dir):
    """Values known for a third of the events, interpolated, as day offsets that rise by one at least."""
    number = F.row_number().over(Window.partitionBy("user_id").orderBy("event_id"))
    rows = table(spark, sf_dir, "events").where("value IS NOT NULL").select("user_id", "event_id", number.alias("n"), F.when(F.col("event_id") % 3 == 0, F.col("value")).alias("v"))
    filled = windows.with_interpolated(rows, ["user_id"], "n", "v", "x").withColumn("o", F.floor(F.col("x") * 10).cast("long"))
    return filled.select("user_id", "event_id", F.col("x").alias("value"), windows.monotone_offsets(F.col("o"), ["user_id"], [F.col("n")]).alias("day_offset"))


@query("SELECT user_id, count(*) AS n_breaks FROM (SELECT user_id, value, lag(value) OVER (PARTITION BY user_id ORDER BY event_id) AS p FROM events) WHERE value < p GROUP BY user_id")
def chronology_breaks(spark, sf_dir):
    """How often a user's value falls from one event to the next."""
    return windows.order_breaks(table(spark, sf_dir, "events"), ["user_id"], "event_id", "value").groupBy("user_id").agg(F.count(F.lit(1)).alias("n_breaks"))


@query("""
WITH f AS (SELECT l_orderkey, count(*) AS n, count(DISTINCT l_linenumber) AS d, min(l_linenumber) AS lo, max(l_linenumber) AS hi, max(l_quantity) AS c, count(DISTINCT l_returnflag) AS s FROM lineitem GROUP BY l_orderkey)
SELECT 'numbers' AS rule, count(*) AS n_orders FROM f WHERE d <> n OR lo <> 1 OR hi <> n
UNION ALL SELECT 'split', count(*) FROM f WHERE s > 1""")
def cohort_contract_check(spark, sf_dir):
    """Orders whose lines aren't numbered without gaps, or that cross return flags."""
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", (F.col("l_linenumber") - 1).alias("number"), F.lit(None).cast("int").alias("count"), F.lit(None).cast("string").alias("multiple"), F.lit("x").alias("text"), F.col("l_returnflag").alias("split"))
    found = contracts.numbered_set_violations(rows, ["l_orderkey"], "number", "count", "multiple", "text", "split")
    return found.where(F.col("rule").isin("numbers", "split")).groupBy("rule").agg(F.count(F.lit(1)).alias("n_orders"))


@query("""
WITH e AS (SELECT lang, role, want FROM (SELECT DISTINCT lang FROM documents), (VALUES (0, 30), (1, 10)) w(role, want)),
c AS (SELECT lang, quality AS role, count(*) AS n FROM documents JOIN labels USING (doc_id) GROUP BY ALL)
SELECT lang, role, coalesce(n, 0) AS n, coalesce(want, 0) AS wanted FROM e FULL JOIN c USING (lang, role) WHERE coalesce(n, 0) <> coalesce(want, 0)""")
def coverage_gaps(spark, sf_dir):
    """Cells of language and quality that haven't the expected number of documents."""
    rows = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id").select("lang", F.col("quality").cast("int").alias("role"))
    return contracts.coverage_gaps(rows, "lang", "role", {0: 30, 1: 10}).select("lang", "role", F.col("n"), F.col("wanted").cast("long").alias("wanted"))


@query("SELECT c_custkey, o_orderkey, c_mktsegment FROM customer JOIN orders ON o_custkey = c_custkey AND (o_orderkey % 2 = 0) = (c_custkey % 2 = 0)")
def lineage_expand(spark, sf_dir):
    """Each customer with all orders of the same split."""
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", (F.col("c_custkey") % 2).alias("split"))
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", (F.col("o_orderkey") % 2).alias("split"))
    return joins.lineage(customers, orders, "c_custkey", "o_custkey", "split").select("c_custkey", "o_orderkey", "c_mktsegment")


@query("""
SELECT s_suppkey, coalesce(region, CASE WHEN s_nationkey IS NOT NULL THEN 'REGION of ' || n_name END) AS region, CASE WHEN region IS NOT NULL THEN 'own' WHEN n_name IS NOT NULL THEN 'lookup' END AS source
FROM (SELECT s_suppkey, s_nationkey, CASE WHEN s_suppkey % 3 = 0 THEN s_name END AS region FROM supplier) LEFT JOIN nation ON n_nationkey = s_nationkey""")
def map_fill_provenance(spark, sf_dir):
    """Nulls filled from a lookup, and where each value came from."""
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey", F.when(F.col("s_suppkey") % 3 == 0, F.col("s_name")).alias("region"))
    lookup = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("s_nationkey"), F.concat(F.lit("REGION of "), "n_name").alias("value"))
    return joins.fill_from_map(suppliers, lookup, "s_nationkey", "region", "value", "source").select("s_suppkey", "region", "source")


@query("""
WITH a AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderstatus = 'F'), b AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderstatus = 'P')
SELECT count(*) FILTER (WHERE a.k IS NOT NULL AND b.k IS NOT NULL) AS n_both, count(*) FILTER (WHERE b.k IS NULL) AS n_left, count(*) FILTER (WHERE a.k IS NULL) AS n_right FROM a FULL JOIN b ON a.k = b.k""")
def overlap_counts(spark, sf_dir):
    """Customers with finished orders, pending ones, and both."""
    orders = table(spark, sf_dir, "orders")
    return dedup.overlap_counts(orders.where("o_orderstatus = 'F'"), orders.where("o_orderstatus = 'P'"), "o_custkey")


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_custkey IS NOT NULL AND o_orderstatus = 'P' AND year(o_orderdate) = 1999) AND c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey < 3)")
def semi_anti_filters(spark, sf_dir):
    """Customers of some regions without a pending order of 1999."""
    customers = table(spark, sf_dir, "customer")
    near = customers.join(table(spark, sf_dir, "nation").where("n_regionkey < 3").select(F.col("n_nationkey").alias("c_nationkey")), "c_nationkey", "left_semi")
    return dedup.unlabelled(near.withColumnRenamed("c_custkey", "k"), table(spark, sf_dir, "orders").where("o_orderstatus = 'P' AND year(o_orderdate) = 1999").select(F.col("o_custkey").alias("k")), ["k"]).select(F.col("k").alias("c_custkey"))


@query("SELECT s_suppkey, s_nationkey, CASE WHEN row_number() OVER w > 1 THEN s_nationkey::VARCHAR || '-' || row_number() OVER w ELSE s_nationkey::VARCHAR END AS unique_id FROM supplier WINDOW w AS (PARTITION BY s_nationkey ORDER BY s_suppkey)")
def ensure_unique_ids(spark, sf_dir):
    """Ids made unique by a number on their repeats."""
    return windows.unique_ids(table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey"), "s_nationkey", [F.asc("s_suppkey")], "unique_id")
