"""Classification, calibration, agreement and interval metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import hashing
from ..operators import journal, metrics
from .registry import query, table

_LABELLED = """
WITH x AS (SELECT doc_id, lang, quality, toxic, ('0x' || substr(sha256('m:' || doc_id), 1, 8))::UBIGINT % 50 AS bucket FROM labels JOIN documents USING (doc_id)),
d AS (SELECT *, (bucket + 10 * quality) / 60.0::DOUBLE AS p, 1 + doc_id % 3 AS w FROM x)
"""


def _labelled(spark, sf_dir):
    rows = table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents").select("doc_id", "lang"), "doc_id")
    rows = rows.withColumn("bucket", hashing.hash_partition(50, "m", F.col("doc_id")))
    return rows.withColumn("p", (F.col("bucket") + 10 * F.col("quality")) / F.lit(60.0)).withColumn("w", 1 + F.col("doc_id") % 3)


@query(_LABELLED + """, r AS (SELECT quality AS y, p, w, rank() OVER (ORDER BY p) + (count(*) OVER (PARTITION BY p) - 1) / 2.0 AS r FROM d),
s AS (SELECT y, p, sum(y) OVER (ORDER BY p DESC RANGE UNBOUNDED PRECEDING) AS tp, count(*) OVER (ORDER BY p DESC RANGE UNBOUNDED PRECEDING) AS k FROM r)
SELECT (SELECT round((sum(CASE WHEN y = 1 THEN r END) - sum(y) * (sum(y) + 1) / 2.0) / (sum(y) * (count(*) - sum(y))), 6) FROM r) AS auroc,
  (SELECT round(sum(CASE WHEN y = 1 THEN tp / k END) / sum(y), 6) FROM s) AS average_precision, (SELECT round(avg((p - y) ** 2), 6) FROM r) AS brier,
  (SELECT round(sum(a.w * b.w * CASE WHEN a.p > b.p THEN 1 WHEN a.p = b.p THEN 0.5 ELSE 0 END) / sum(a.w * b.w), 6) FROM r a, r b WHERE a.y = 1 AND b.y = 0) AS weighted_auroc""")
def metric_auroc_ap(spark, sf_dir):
    """AUROC (plain and weighted), average precision and Brier score of one probability."""
    rows = _labelled(spark, sf_dir)
    parts = [metrics.auroc(rows, "quality", "p"), metrics.average_precision(rows, "quality", "p"), rows.agg(metrics.brier(F.col("quality"), F.col("p")).alias("brier")), metrics.auroc(rows, "quality", "p", "w", name="weighted_auroc")]
    out = parts[0]
    for other in parts[1:]:
        out = out.join(other)
    return out.select(*(F.round(c, 6).alias(c) for c in out.columns))


@query(_LABELLED + """, r AS (SELECT lang, quality AS y, rank() OVER (PARTITION BY lang ORDER BY p) + (count(*) OVER (PARTITION BY lang, p) - 1) / 2.0 AS r FROM d)
SELECT lang, round((sum(CASE WHEN y = 1 THEN r END) - sum(y) * (sum(y) + 1) / 2.0) / nullif(sum(y) * (count(*) - sum(y)), 0), 6) AS auroc FROM r GROUP BY lang""")
def metric_auroc_by_group(spark, sf_dir):
    """AUROC within each language."""
    return metrics.auroc(_labelled(spark, sf_dir), "quality", "p", by=["lang"]).withColumn("auroc", F.round("auroc", 6))


@query(_LABELLED + """, b AS (SELECT quality AS y, p, ntile(10) OVER (ORDER BY p, doc_id) AS bin FROM d)
SELECT CAST(bin AS INTEGER) AS bin, count(*) AS n, round(avg(p), 6) AS mean_p, round(avg(y), 6) AS rate FROM b GROUP BY bin""")
def metric_reliability(spark, sf_dir):
    """Ten bins of equal mass."""
    found = metrics.reliability(_labelled(spark, sf_dir), "quality", "p", 10, "doc_id")
    return found.select("bin", "n", F.round("mean_p", 6).alias("mean_p"), F.round("rate", 6).alias("rate"))


@query(_LABELLED + """, b AS (SELECT quality AS y, p, ntile(10) OVER (ORDER BY p, doc_id) AS bin FROM d), c AS (SELECT count(*) AS n, avg(p) AS mp, avg(y) AS r FROM b GROUP BY bin)
SELECT round(sum(n * abs(mp - r)) / sum(n), 6) AS ece FROM c""")
def metric_ece(spark, sf_dir):
    """The expected calibration error over ten bins."""
    found = metrics.expected_calibration_error(metrics.reliability(_labelled(spark, sf_dir), "quality", "p", 10, "doc_id"))
    return found.select(F.round("ece", 6).alias("ece"))


@query(_LABELLED + "SELECT CAST(least(floor(p * 25), 24) AS INTEGER) AS bin, count(*) AS n, round(avg(p), 6) AS mean_p, round(avg(quality), 6) AS rate FROM d GROUP BY 1")
def metric_calibration_curve(spark, sf_dir):
    """Twenty-five bins of equal width."""
    found = metrics.calibration_curve(_labelled(spark, sf_dir), "quality", "p", 25)
    return found.select("bin", "n", F.round("mean_p", 6).alias("mean_p"), F.round("rate", 6).alias("rate"))


@query(_LABELLED + """, s AS (SELECT p, sum(quality) OVER (ORDER BY p DESC RANGE UNBOUNDED PRECEDING) AS tp, count(*) OVER (ORDER BY p DESC RANGE UNBOUNDED PRECEDING) AS k, sum(quality) OVER () AS n FROM d),
f AS (SELECT p, 2 * tp / (k + n) AS f FROM s) SELECT round(max(f), 6) AS best_f1, round(max(p) FILTER (WHERE f = (SELECT max(f) FROM f)), 6) AS threshold FROM f""")
def metric_best_f1(spark, sf_dir):
    """The best F1 over all thresholds."""
    return metrics.best_f1(_labelled(spark, sf_dir), "quality", "p").select(F.round("best_f1", 6).alias("best_f1"), F.round("threshold", 6).alias("threshold"))


@query("""
WITH t AS (SELECT quality = 1 AS a, n_chars > 1500 AS b FROM labels JOIN documents USING (doc_id)), n AS (SELECT count(*) AS n, avg((a = b)::INT) AS o FROM t),
e AS (SELECT sum(pa * pb) AS e FROM (SELECT a AS v, count(*) / (SELECT n FROM n) AS pa FROM t GROUP BY a) JOIN (SELECT b AS v, count(*) / (SELECT n FROM n) AS pb FROM t GROUP BY b) USING (v))
SELECT n, round(o, 6) AS agreement, round((o - e) / nullif(1 - e, 0), 6) AS kappa FROM n, e""")
def metric_kappa(spark, sf_dir):
    """Cohen's kappa of the quality label and a length rule."""
    rows = table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents"), "doc_id").select((F.col("quality") == 1).alias("a"), (F.col("n_chars") > 1500).alias("b"))
    return metrics.cohens_kappa(rows, "a", "b").select("n", F.round("agreement", 6).alias("agreement"), F.round("kappa", 6).alias("kappa"))


@query("""
WITH r AS (SELECT l_quantity AS a, l_extendedprice / 2000 AS b, rank() OVER (ORDER BY l_quantity) + (count(*) OVER (PARTITION BY l_quantity) - 1) / 2.0 AS ra, rank() OVER (ORDER BY l_extendedprice) + (count(*) OVER (PARTITION BY l_extendedprice) - 1) / 2.0 AS rb FROM lineitem)
SELECT round(corr(a, b), 6) AS pearson, round(corr(ra, rb), 6) AS spearman, round(avg(abs(b - a)), 5) AS mae, round(sqrt(avg((b - a) ** 2)), 5) AS rmse, round(avg(b - a), 5) AS bias, round(1 - sum((b - a) ** 2) / (var_pop(a) * count(a)), 5) AS r2 FROM r""")
def metric_corr_regression(spark, sf_dir):
    """Pearson, Spearman and regression errors of two columns."""
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_quantity").alias("a"), (F.col("l_extendedprice") / 2000).alias("b"))
    errors = rows.agg(F.corr("a", "b").alias("pearson"), *metrics.regression_errors(F.col("a"), F.col("b"))).join(metrics.spearman(rows, "a", "b"))
    return errors.select(F.round("pearson", 6).alias("pearson"), F.round("spearman", 6).alias("spearman"), *(F.round(c, 5).alias(c) for c in ("mae", "rmse", "bias", "r2")))


@query("""
WITH u AS (SELECT o_custkey, sum(o_totalprice) AS s, count(o_totalprice) AS c, row_number() OVER (ORDER BY o_custkey) - 1 AS number FROM orders GROUP BY o_custkey),
n AS (SELECT count(*) AS n FROM u), picks AS (SELECT draw, ('0x' || substr(sha256('boot:' || draw || ':' || pick), 1, 8))::UBIGINT % n AS number FROM range(200) a(draw), n, range(1000000) b(pick) WHERE pick < n),
m AS (SELECT draw, sum(s) / sum(c) AS mean FROM picks JOIN u USING (number) GROUP BY draw)
SELECT (SELECT n FROM n) AS n_units, count(*) AS draws, round(quantile_cont(mean, 0.025), 2) AS low, round(quantile_cont(mean, 0.5), 2) AS middle, round(quantile_cont(mean, 0.975), 2) AS high FROM m""".replace("range(1000000) b(pick) WHERE pick < n", "LATERAL (SELECT unnest(range(n)) AS pick)"))
def bootstrap_cluster_ci(spark, sf_dir):
    """A percentile interval of the mean price over customers drawn with replacement."""
    found = metrics.bootstrap(table(spark, sf_dir, "orders"), "o_custkey", "o_totalprice", 200, "boot")
    return found.select(F.col("n_units").cast("long").alias("n_units"), "draws", *(F.round(c, 2).alias(c) for c in ("low", "middle", "high")))


@query("""
WITH j AS (SELECT c_mktsegment AS segment, o_orderstatus AS status, n_regionkey::VARCHAR AS region, o_totalprice AS v FROM orders LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN nation ON n_nationkey = c_nationkey),
g AS (SELECT CASE WHEN grouping(segment) = 0 THEN 'segment' WHEN grouping(status) = 0 THEN 'status' WHEN grouping(region) = 0 THEN 'region' ELSE 'overall' END AS dimension,
  CASE WHEN grouping(segment, status, region) = 7 THEN 'all' ELSE coalesce(segment, status, region, 'Unknown') END AS category, count(*) AS n, avg((v > 200000)::INT) AS rate FROM j GROUP BY GROUPING SETS ((), (segment), (status), (region)))
SELECT dimension, category, n, CASE WHEN n >= 20 THEN round(rate, 6) END AS rate FROM g""")
def stratified_metric(spark, sf_dir):
    """A rate over all orders and within each value of three dimensions, if they have 20 rows."""
    customers = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
    rows = table(spark, sf_dir, "orders").join(customers, F.col("o_custkey") == F.col("c_custkey"), "left").select(F.col("c_mktsegment").alias("segment"), F.col("o_orderstatus").alias("status"), F.col("n_regionkey").cast("string").alias("region"), "o_totalprice")
    return metrics.stratified(rows, ["segment", "status", "region"], 20, {"rate": F.round(F.avg((F.col("o_totalprice") > 200000).cast("double")), 6)})


@query(_LABELLED + """, c AS (SELECT lang AS a, CASE WHEN bucket < 40 THEN lang ELSE 'en' END AS g FROM d), k AS (SELECT DISTINCT a AS class FROM c UNION SELECT g FROM c),
m AS (SELECT class, count(*) FILTER (WHERE a = class) AS support, count(*) FILTER (WHERE g = class) AS pred, count(*) FILTER (WHERE a = class AND g = class) AS hit FROM c, k GROUP BY class)
SELECT class, support, round(coalesce(hit / nullif(pred, 0), 0), 6) AS precision, round(coalesce(hit / nullif(support, 0), 0), 6) AS recall, round(coalesce(2 * hit / nullif(support + pred, 0), 0), 6) AS f1 FROM m""")
def metric_class_report(spark, sf_dir):
    """Precision, recall and F1 of each class."""
    rows = _labelled(spark, sf_dir).withColumn("guess", F.when(F.col("bucket") < 40, F.col("lang")).otherwise("en"))
    found = metrics.class_report(rows, "lang", "guess")
    return found.select("class", "support", *(F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")))


@query(_LABELLED + """, s AS (SELECT c AS class, (lang = c)::INT AS y, rank() OVER (PARTITION BY c ORDER BY x) + (count(*) OVER (PARTITION BY c, x) - 1) / 2.0 AS r
  FROM (SELECT lang, unnest(['en', 'de']) AS c, unnest([p, 1 - p]) AS x FROM d))
SELECT class, round((sum(CASE WHEN y = 1 THEN r END) - sum(y) * (sum(y) + 1) / 2.0) / nullif(sum(y) * (count(*) - sum(y)), 0), 6) AS auroc FROM s GROUP BY class""")
def metric_one_vs_rest(spark, sf_dir):
    """AUROC of two classes against the rest."""
    rows = _labelled(spark, sf_dir).withColumn("q", 1 - F.col("p"))
    return metrics.one_vs_rest_auroc(rows, "lang", {"en": "p", "de": "q"}).withColumn("auroc", F.round("auroc", 6))


_UNITS = """
WITH u AS (SELECT doc_id, CASE WHEN doc_id % 4 <> 1 THEN 'k' || doc_id % 2 END AS kind, CASE WHEN doc_id % 7 <> 0 THEN quality END AS a, CASE WHEN doc_id % 5 <> 0 THEN toxic END AS b, CASE WHEN doc_id % 6 = 0 THEN quality END AS decided FROM labels),
s AS (SELECT *, CASE WHEN a IS NULL AND b IS NULL THEN 'missing' WHEN a IS NULL OR b IS NULL THEN 'single' WHEN a = b THEN 'agreed' ELSE 'disputed' END AS status, coalesce(decided, CASE WHEN a = b THEN a END) AS gold FROM u)
"""


def _units(spark, sf_dir):
    part = lambda m, c: F.when(F.col("doc_id") % m != 0, F.col(c))
    rows = table(spark, sf_dir, "labels").select("doc_id", F.when(F.col("doc_id") % 4 != 1, F.concat(F.lit("k"), (F.col("doc_id") % 2).cast("string"))).alias("kind"), part(7, "quality").alias("a"), part(5, "toxic").alias("b"), F.when(F.col("doc_id") % 6 == 0, F.col("quality")).alias("decided"))
    return rows.withColumn("status", journal.unit_status(F.col("a"), F.col("b"))).withColumn("gold", journal.gold(F.col("decided"), F.col("a"), F.col("b")))


@query(_UNITS + "SELECT doc_id, status, gold FROM s")
def unit_status_gold(spark, sf_dir):
    """Statuses and gold values of units that two judges saw."""
    return _units(spark, sf_dir).select("doc_id", "status", "gold")


@query(_UNITS + """SELECT kind, count(*) AS n, count(*) FILTER (WHERE status = 'agreed') AS n_agreed, count(*) FILTER (WHERE status = 'disputed') AS n_disputed, count(*) FILTER (WHERE status = 'single') AS n_single,
 round(avg((a = b)::INT), 6) AS agreement, round(avg((a = gold)::INT), 6) AS accuracy_a, round(avg((b = gold)::INT), 6) AS accuracy_b, count(*) FILTER (WHERE a = b AND a <> gold) AS n_both_wrong FROM s GROUP BY kind""")
def judge_agreement(spark, sf_dir):
    """Agreement and accuracy against gold by kind of unit."""
    found = journal.agreement(_units(spark, sf_dir), "kind", "a", "b", "gold", "status")
    return found.select(*(F.round(c, 6).alias(c) if c in ("agreement", "accuracy_a", "accuracy_b") else F.col(c) for c in found.columns))


@query("SELECT quality AS old, toxic AS new, count(*) AS n FROM labels GROUP BY ALL")
def label_transitions(spark, sf_dir):
    """How often one label became another."""
    rows = table(spark, sf_dir, "labels")
    return journal.transitions(rows.select("doc_id", F.col("quality").alias("v")), rows.select("doc_id", F.col("toxic").alias("v")), "doc_id", "v")


@query("SELECT l_suppkey, round(sum(l_tax * l_quantity) / nullif(sum(l_quantity), 0), 6) AS rate, quantile_cont(l_quantity, 0.25) AS q25, quantile_cont(l_quantity, 0.9) AS q90, max(CASE l_returnflag WHEN 'N' THEN 0 WHEN 'A' THEN 1 WHEN 'R' THEN 2 END) AS worst_rank FROM lineitem GROUP BY l_suppkey")
def weighted_rates_quantiles(spark, sf_dir):
    """A weighted rate, exact quantiles and the worst flag of each supplier."""
    rows = table(spark, sf_dir, "lineitem")
    rank = F.coalesce(*(F.when(F.col("worst") == v, F.lit(i)) for i, v in enumerate(("N", "A", "R"))))
    found = rows.groupBy("l_suppkey").agg(F.round(metrics.weighted_rate(F.col("l_tax"), F.col("l_quantity")), 6).alias("rate"), F.percentile("l_quantity", 0.25).alias("q25"), F.percentile("l_quantity", 0.9).alias("q90"), journal.worst(F.col("l_returnflag"), ("N", "A", "R")).alias("worst"))
    return found.withColumn("worst_rank", rank).drop("worst")


@query("SELECT lang, quality, toxic, count(*) AS n FROM documents JOIN labels USING (doc_id) GROUP BY ALL")
def crosstab_counts(spark, sf_dir):
    """Documents by language and both labels."""
    return table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id").groupBy("lang", "quality", "toxic").agg(F.count(F.lit(1)).alias("n"))


@query(_LABELLED.replace("WITH x AS", "WITH RECURSIVE x AS") + """, r AS (SELECT quality AS y, ln(greatest(least(p, 1 - 1e-6), 1e-6) / (1 - greatest(least(p, 1 - 1e-6), 1e-6))) AS x FROM d),
shift(k, b) AS (SELECT 0, 0.0::DOUBLE UNION ALL SELECT k + 1, b + g / h FROM shift, LATERAL (SELECT sum(y - s) AS g, sum(s * (1 - s)) AS h FROM (SELECT y, 1 / (1 + exp(-(b + x))) AS s FROM r)) WHERE k < 25),
line(k, a, b) AS (SELECT 0, 0.0::DOUBLE, 0.0::DOUBLE UNION ALL SELECT k + 1, a + (h11 * g0 - h01 * g1) / (h00 * h11 - h01 * h01), b + (h00 * g1 - h01 * g0) / (h00 * h11 - h01 * h01) FROM line,
  LATERAL (SELECT sum(y - s) AS g0, sum((y - s) * x) AS g1, sum(s * (1 - s)) AS h00, sum(s * (1 - s) * x) AS h01, sum(s * (1 - s) * x * x) AS h11 FROM (SELECT y, x, 1 / (1 + exp(-(a + b * x))) AS s FROM r)) WHERE k < 25)
SELECT (SELECT round(b, 5) FROM shift WHERE k = 25) AS intercept, (SELECT round(b, 5) FROM line WHERE k = 25) AS slope""")
def metric_calibration_fit(spark, sf_dir):
    """Calibration in the large and slope of one probability, by Newton steps over its distinct values."""
    intercept, slope = metrics.calibration_fit(_labelled(spark, sf_dir), "quality", "p")
    return spark.createDataFrame([(round(intercept, 5), round(slope, 5))], "intercept double, slope double")
