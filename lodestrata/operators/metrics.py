"""Ranking, classification, calibration and agreement metrics as aggregates.

Metrics over an order first add rows up by distinct score, then run sums over ranges of the score
(``windows.running_totals``): no global sort in one task. Rows whose label or score is null are left
out. A metric that isn't defined (one class only, no weight) is null.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import hash_partition
from .windows import bucket_bounds, global_numbers, range_number, running_totals


def _by_score(frame: DataFrame, label: str, score: str, weight: str | None, by: Sequence[str], down: bool) -> DataFrame:
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    order = -F.col(score).cast("double") if down else F.col(score).cast("double")
    rows = frame.where(F.col(label).isNotNull() & F.col(score).isNotNull()).select(*by, order.alias("__s"), (F.col(label).cast("int") * w).alias("__p"), ((1 - F.col(label).cast("int")) * w).alias("__n"))
    return rows.groupBy(*by, "__s").agg(F.sum("__p").alias("__p"), F.sum("__n").alias("__n"))


def auroc(frame: DataFrame, label: str, score: str, weight: str | None = None, by: Sequence[str] = (), name: str = "auroc") -> DataFrame:
    """Area under the ROC curve: the (weighted) share of pairs in order, ties counting half."""
    runs = running_totals(_by_score(frame, label, score, weight, by, False), "__s", ["__n"], by=by)
    area = F.sum(F.col("__p") * (F.col("cum___n") - F.col("__n") / 2))
    return runs.groupBy(*by).agg(F.try_divide(area, F.sum("__p") * F.sum("__n")).alias(name))


def average_precision(frame: DataFrame, label: str, score: str, weight: str | None = None, by: Sequence[str] = (), name: str = "average_precision") -> DataFrame:
    """Average precision, scores that tie taken together."""
    runs = running_totals(_by_score(frame, label, score, weight, by, True), "__s", ["__p", "__n"], by=by)
    gain = F.sum(F.col("__p") * F.try_divide(F.col("cum___p"), F.col("cum___p") + F.col("cum___n")))
    return runs.groupBy(*by).agg(F.try_divide(gain, F.sum("__p")).alias(name))


def best_f1(frame: DataFrame, label: str, score: str, name: str = "best_f1") -> DataFrame:
    """The largest F1 over all thresholds, and the (largest) threshold that has it."""
    groups = _by_score(frame, label, score, None, (), True)
    runs = running_totals(groups, "__s", ["__p", "__n"]).join(groups.agg(F.sum("__p").alias("__all")))
    f1 = F.try_divide(2 * F.col("cum___p"), F.col("cum___p") + F.col("cum___n") + F.col("__all"))
    return runs.select(f1.alias("__f"), "__s").agg(F.max("__f").alias(name), (-F.max_by(F.col("__s"), F.struct("__f", -F.col("__s")))).alias("threshold"))


def brier(label: Column, p: Column, weight: Column | None = None) -> Column:
    """Aggregate: mean squared error of a probability."""
    error = (p - label.cast("double")) ** 2
    return F.avg(error) if weight is None else F.try_divide(F.sum(error * weight), F.sum(weight))


def weighted_rate(value: Column, weight: Column) -> Column:
    """Aggregate: sum(w * y) / sum(w); null without weight."""
    return F.try_divide(F.sum(value * weight), F.sum(F.when(value.isNotNull(), weight)))


def reliability(frame: DataFrame, label: str, p: str, bins: int, tie: str) -> DataFrame:
    """Equal-mass bins in the order of (p, tie): the first n % bins get one row more. ``bin`` from 1, ``n``, ``mean_p``, ``rate``.

    Numbers come from ranges of p and, within a range, a sort by (p, tie); no task holds all rows.
    """
    rows = frame.where(F.col(label).isNotNull() & F.col(p).isNotNull()).select(F.col(label).cast("double").alias("__y"), F.col(p).cast("double").alias("__p"), F.col(tie).alias("__tie"))
    bounds = bucket_bounds(rows, "__p", 64)
    cut = rows.withColumn("__b", range_number(F.col("__p"), bounds))
    sizes = cut.groupBy("__b").count()
    before = sizes.select("__b", (F.sum("count").over(Window.orderBy("__b")) - F.col("count")).alias("__before"), F.sum("count").over(Window.partitionBy(F.lit(0))).alias("__n"))
    place = F.col("__before") + F.row_number().over(Window.partitionBy("__b").orderBy("__p", "__tie")) - 1
    big, extra = F.floor(F.col("__n") / bins), F.col("__n") % bins
    number = F.when(F.col("__place") < extra * (big + 1), F.floor(F.col("__place") / (big + 1))).otherwise(extra + F.floor((F.col("__place") - extra * (big + 1)) / F.greatest(big, F.lit(1))))
    return cut.join(F.broadcast(before), "__b").withColumn("__place", place).withColumn("bin", (number + 1).cast("int")).groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.avg("__p").alias("mean_p"), F.avg("__y").alias("rate"))


def expected_calibration_error(table: DataFrame, name: str = "ece") -> DataFrame:
    """From a reliability table: the mean gap between probability and rate, weighted by bin size."""
    return table.agg(F.try_divide(F.sum(F.col("n") * F.abs(F.col("mean_p") - F.col("rate"))), F.sum("n")).alias(name))


def calibration_curve(frame: DataFrame, label: str, score: str, bins: int) -> DataFrame:
    """Bins of equal width; scores outside 0..1 are first scaled to their range."""
    rows = frame.where(F.col(label).isNotNull() & F.col(score).isNotNull())
    span = rows.agg(F.min(score).alias("__lo"), F.max(score).alias("__hi"))
    scaled = F.when((F.col("__lo") < 0) | (F.col("__hi") > 1), F.coalesce(F.try_divide(F.col(score) - F.col("__lo"), F.col("__hi") - F.col("__lo")), F.lit(0.0))).otherwise(F.col(score))
    number = F.least(F.floor(F.col("__p") * bins), F.lit(bins - 1)).cast("int")
    return rows.join(F.broadcast(span)).withColumn("__p", scaled).withColumn("bin", number).groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.avg("__p").alias("mean_p"), F.avg(F.col(label).cast("double")).alias("rate"))


def _newton(rows: DataFrame, slope: bool, steps: int, tolerance: float) -> tuple[float, float]:
    """Logistic regression of counts y of n on x (slope False: x is an offset), one aggregate a step."""
    b0, b1 = 0.0, 0.0 if slope else 1.0
    for _ in range(steps):
        mu = 1 / (1 + F.exp(-(F.lit(b0) + F.lit(b1) * F.col("x"))))
        cells = rows.select("x", (F.col("y") - F.col("n") * mu).alias("r"), (F.col("n") * F.greatest(mu * (1 - mu), F.lit(1e-12))).alias("w"))
        s = cells.agg(F.sum("r"), F.sum(F.col("r") * F.col("x")), F.sum("w"), F.sum(F.col("w") * F.col("x")), F.sum(F.col("w") * F.col("x") * F.col("x"))).first()
        g0, g1, h00, h01, h11 = (float(v) for v in s)
        step = np.linalg.lstsq(np.array([[h00, h01], [h01, h11]]), np.array([g0, g1]), rcond=None)[0] if slope else np.array([g0 / h00, 0.0])
        b0, b1 = b0 + float(step[0]), b1 + float(step[1])
        if np.abs(step).max() < tolerance:
            break
    return b0, b1


def calibration_fit(frame: DataFrame, label: str, p: str, eps: float = 1e-6, steps: int = 50, tolerance: float = 1e-10) -> tuple[float, float]:
    """Calibration in the large (the intercept with logit(p) as an offset) and the slope of the label on logit(p); nan with one class.

    Rows are added up by probability first; each Newton step is one small aggregate.
    """
    q = F.least(F.greatest(F.col(p).cast("double"), F.lit(eps)), F.lit(1 - eps))
    rows = frame.where(F.col(label).isNotNull() & F.col(p).isNotNull()).select(F.log(q / (1 - q)).alias("x"), F.col(label).cast("double").alias("y")).groupBy("x").agg(F.sum("y").alias("y"), F.count(F.lit(1)).alias("n")).cache()
    try:
        total = rows.agg(F.sum("y"), F.sum("n")).first()
        if not total[1] or total[0] in (0, total[1]):
            return float("nan"), float("nan")
        return _newton(rows, False, steps, tolerance)[0], _newton(rows, True, steps, tolerance)[1]
    finally:
        rows.unpersist()


def mid_ranks(frame: DataFrame, value: str, name: str) -> DataFrame:
    """``name``: ranks from 1, ties sharing the mean of theirs."""
    groups = frame.where(F.col(value).isNotNull()).groupBy(F.col(value).cast("double").alias("__s")).agg(F.count(F.lit(1)).alias("__c"))
    runs = running_totals(groups, "__s", ["__c"]).select("__s", (F.col("cum___c") - (F.col("__c") - 1) / 2).alias(name))
    return frame.withColumn("__s", F.col(value).cast("double")).join(runs, "__s", "left").drop("__s")


def spearman(frame: DataFrame, a: str, b: str, name: str = "spearman") -> DataFrame:
    """The correlation of mid-ranks."""
    rows = frame.where(F.col(a).isNotNull() & F.col(b).isNotNull()).select(a, b)
    return mid_ranks(mid_ranks(rows, a, "__ra"), b, "__rb").agg(F.corr("__ra", "__rb").alias(name))


def regression_errors(truth: Column, guess: Column) -> list[Column]:
    """Aggregates: mae, rmse, bias and r2."""
    gap = guess - truth
    return [F.avg(F.abs(gap)).alias("mae"), F.sqrt(F.avg(gap * gap)).alias("rmse"), F.avg(gap).alias("bias"), (1 - F.try_divide(F.sum(gap * gap), F.var_pop(truth) * F.count(truth))).alias("r2")]


def cohens_kappa(frame: DataFrame, a: str, b: str) -> DataFrame:
    """``n``, ``agreement`` and ``kappa`` of two raters over rows that both rated; kappa is null if chance is certain."""
    cells = frame.where(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(F.col(a).cast("string").alias("a"), F.col(b).cast("string").alias("b")).agg(F.count(F.lit(1)).alias("n"))
    of_a, of_b = cells.groupBy("a").agg(F.sum("n").alias("na")), cells.groupBy(F.col("b").alias("a")).agg(F.sum("n").alias("nb"))
    chance = of_a.join(of_b, "a").agg(F.sum(F.col("na") * F.col("nb")).alias("chance"))
    total = cells.agg(F.sum("n").alias("n"), F.sum(F.when(F.col("a") == F.col("b"), F.col("n")).otherwise(0)).alias("same"))
    e = F.coalesce("chance", F.lit(0)) / (F.col("n") * F.col("n"))
    o = F.col("same") / F.col("n")
    return total.join(chance).select("n", o.alias("agreement"), F.try_divide(o - e, 1 - e).alias("kappa"))


def confusion(frame: DataFrame, truth: str, guess: str) -> DataFrame:
    """``actual``, ``predicted``, ``n``."""
    return frame.groupBy(F.col(truth).alias("actual"), F.col(guess).alias("predicted")).agg(F.count(F.lit(1)).alias("n"))


def class_report(frame: DataFrame, truth: str, guess: str) -> DataFrame:
    """Precision, recall, F1 and support of each class that is true or predicted."""
    cells = confusion(frame.where(F.col(truth).isNotNull() & F.col(guess).isNotNull()), truth, guess)
    both = cells.select(F.explode(F.array(F.struct(F.col("actual").alias("class"), F.col("n").alias("s"), F.lit(0).cast("long").alias("q")), F.struct(F.col("predicted").alias("class"), F.lit(0).cast("long").alias("s"), F.col("n").alias("q")))).alias("x"), F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0).alias("hit"))
    sums = both.groupBy(F.col("x.class").alias("class")).agg(F.sum("x.s").alias("support"), F.sum("x.q").alias("predicted"), (F.sum("hit") / 2).alias("hits"))
    return sums.select("class", "support", F.coalesce(F.try_divide("hits", "predicted"), F.lit(0.0)).alias("precision"), F.coalesce(F.try_divide("hits", "support"), F.lit(0.0)).alias("recall"), F.coalesce(F.try_divide(2 * F.col("hits"), F.col("support") + F.col("predicted")), F.lit(0.0)).alias("f1"))


def multiclass_summary(report: DataFrame) -> DataFrame:
    """Accuracy, macro F1 and support-weighted F1 from a class report."""
    return report.agg(F.try_divide(F.sum(F.col("recall") * F.col("support")), F.sum("support")).alias("accuracy"), F.avg("f1").alias("macro_f1"), F.try_divide(F.sum(F.col("f1") * F.col("support")), F.sum("support")).alias("weighted_f1"))


def one_vs_rest_auroc(frame: DataFrame, truth: str, scores: dict[str, str]) -> DataFrame:
    """``class`` and AUROC of its score column against all other classes."""
    classes = F.explode(F.array(*(F.struct(F.lit(c).alias("class"), (F.col(truth).cast("string") == c).alias("__y"), F.col(s).cast("double").alias("__score")) for c, s in scores.items()))).alias("x")
    return auroc(frame.select(classes).select("x.*"), "__y", "__score", by=["class"])


def precision_at_k(hits: DataFrame, query: Sequence[str], relevant: Column, score: Column) -> DataFrame:
    """A cell for each query: rows, labelled and unlabelled ones, precision over the labelled, mean score."""
    return hits.groupBy(*query).agg(F.count(F.lit(1)).alias("n"), F.count(relevant).alias("n_labelled"), F.count_if(relevant.isNull()).alias("n_unlabelled"), F.avg(relevant.cast("double")).alias("precision"), F.avg(score).alias("mean_score"))


def average_precision_at_k(hits: DataFrame, query: Sequence[str], rank: str, relevant: str, k: int, name: str = "ap") -> DataFrame:
    """Mean of the precisions at relevant ranks up to ``k``; 0 without any."""
    w = Window.partitionBy(*query).orderBy(rank)
    rows = hits.where(F.col(rank) <= k).withColumn("__y", F.col(relevant).cast("int")).withColumn("__hits", F.sum("__y").over(w)).withColumn("__place", F.row_number().over(w))
    return rows.groupBy(*query).agg(F.coalesce(F.try_divide(F.sum(F.col("__y") * F.col("__hits") / F.col("__place")), F.sum("__y")), F.lit(0.0)).alias(name))


def ndcg_at_k(hits: DataFrame, query: Sequence[str], rank: str, gain: str, k: int, name: str = "ndcg") -> DataFrame:
    """Linear gains with a log2 discount over those of the best order; 0 without gains."""
    place, ideal = F.row_number().over(Window.partitionBy(*query).orderBy(rank)), F.row_number().over(Window.partitionBy(*query).orderBy(F.desc(gain), rank))
    share = lambda at: F.sum(F.when(F.col(at) <= k, F.col(gain) / F.log2(F.col(at) + 1)).otherwise(0.0))
    return hits.withColumn("__at", place).withColumn("__best", ideal).groupBy(*query).agg(F.coalesce(F.try_divide(share("__at"), share("__best")), F.lit(0.0)).alias(name))


def coverage_by_threshold(pairs: DataFrame, person: str, score: str, thresholds: Sequence[float]) -> DataFrame:
    """The share of persons with a pair at or above each threshold."""
    best = pairs.groupBy(person).agg(F.max(score).alias("__best"))
    cells = F.array(*(F.struct(F.lit(float(t)).alias("threshold"), F.avg((F.col("__best") >= t).cast("double")).alias("coverage")) for t in thresholds))
    return best.agg(cells.alias("c")).select(F.inline("c"))


def stratified(frame: DataFrame, dimensions: Sequence[str], least: int, measures: dict[str, Column]) -> DataFrame:
    """Measures over all rows and over each value of each dimension, null below ``least`` rows (grouping sets, one pass)."""
    cells = F.explode(F.array(F.struct(F.lit("overall").alias("dimension"), F.lit("all").alias("category")), *(F.struct(F.lit(d).alias("dimension"), F.coalesce(F.col(d).cast("string"), F.lit("Unknown")).alias("category")) for d in dimensions))).alias("__cell")
    out = frame.select("*", cells).groupBy("__cell").agg(F.count(F.lit(1)).alias("n"), *(c.alias(name) for name, c in measures.items()))
    return out.select("__cell.*", "n", *(F.when(F.col("n") >= least, F.col(name)).alias(name) for name in measures))


def bootstrap(frame: DataFrame, unit: str, value: str, draws: int, seed: str, levels: Sequence[float] = (0.025, 0.5, 0.975)) -> DataFrame:
    """Percentile interval of the mean over units drawn with replacement, clusters whole.

    Units are added up first. A draw of n units is made by hash: the i-th pick of a draw is unit number
    hash(seed, draw, i) modulo n, joined back by number. Draws without rows are left out.
    """
    units = frame.groupBy(unit).agg(F.sum(value).alias("s"), F.count(value).alias("c"))
    if dict(units.dtypes)[unit] in ("string", "date", "timestamp", "timestamp_ntz", "boolean"):
        units = units.withColumn(unit, F.xxhash64(unit))  # any fixed order of the units will do
    numbered = global_numbers(units.where(F.col(unit).isNotNull()), unit, "place").select((F.col("place") - 1).alias("number"), "s", "c")
    n = units.where(F.col(unit).isNotNull()).count()
    if not n:
        return frame.sparkSession.createDataFrame([], "n_units long, draws long, low double, middle double, high double")
    picks = frame.sparkSession.range(draws * n).select((F.col("id") / n).cast("long").alias("draw"), (F.col("id") % n).alias("pick"))
    picks = picks.select("draw", hash_partition(n, seed, F.col("draw"), F.col("pick")).alias("number")).groupBy("draw", "number").agg(F.count(F.lit(1)).alias("m"))
    means = picks.join(numbered, "number").groupBy("draw").agg(F.try_divide(F.sum(F.col("m") * F.col("s")), F.sum(F.col("m") * F.col("c"))).alias("mean")).where("mean IS NOT NULL")
    return means.agg(F.lit(n).alias("n_units"), F.count(F.lit(1)).alias("draws"), *(F.percentile("mean", p).alias(name) for p, name in zip(levels, ("low", "middle", "high"), strict=True)))


def bootstrap_metric(frame: DataFrame, unit: str, metric, draws: int, seed: str, levels: Sequence[float] = (0.025, 0.5, 0.975)) -> DataFrame:
    """Percentile interval of any metric over units (integers) drawn with replacement, clusters whole.

    metric: a function of a table with the columns ``draw`` and ``weight`` (how often the unit was drawn) that returns
    ``draw`` and ``value``, such as a weighted ``auroc`` by draw. Draws for which it is null don't count.
    """
    units = global_numbers(frame.select(unit).where(F.col(unit).isNotNull()).distinct(), unit, "place")
    n = units.count()
    if not n:
        return frame.sparkSession.createDataFrame([], "n_units long, draws long, low double, middle double, high double")
    picks = frame.sparkSession.range(draws * n).select((F.col("id") / n).cast("long").alias("draw"), (F.col("id") % n).alias("pick"))
    picks = picks.select("draw", (hash_partition(n, seed, F.col("draw"), F.col("pick")) + 1).cast("long").alias("place")).groupBy("draw", "place").agg(F.count(F.lit(1)).cast("double").alias("weight"))
    drawn = frame.join(units, unit).join(picks, "place").drop("place")
    values = metric(drawn).where("value IS NOT NULL")
    return values.agg(F.lit(n).cast("long").alias("n_units"), F.count(F.lit(1)).alias("draws"), *(F.percentile("value", p).alias(name) for p, name in zip(levels, ("low", "middle", "high"), strict=True)))


def scenarios(hits: DataFrame, query: str, rank: str, relevant: str, score: str, k: int, least: float = 1.0) -> DataFrame:
    """Mean average precision at ``k`` of three lists: as ranked, those scored at least ``least``, and these re-ranked by score. Queries without rows in a list don't count in it."""
    kept = hits.where(F.col(score) >= least)
    again = F.row_number().over(Window.partitionBy(query).orderBy(F.desc(score), rank))
    lists = {"base": hits, "filter": kept, "rerank": kept.withColumn(rank, again)}
    place = F.row_number().over(Window.partitionBy(query).orderBy(rank))
    parts = [average_precision_at_k(f.withColumn("__at", place), [query], "__at", relevant, k).agg(F.avg("ap").alias("map"), F.count(F.lit(1)).alias("n_queries")).select(F.lit(name).alias("scenario"), "map", "n_queries") for name, f in lists.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def before_and_after(pairs: DataFrame, before: str, after: str, truth: str, least: float) -> DataFrame:
    """Spearman with the truth and AUROC of truth >= least, for two scores of the same pairs."""
    rows = pairs.withColumn("__y", F.col(truth) >= least)
    parts = [spearman(rows, c, truth).join(auroc(rows, "__y", c)).select(F.lit(c).alias("scorer"), "spearman", "auroc") for c in (before, after)]
    return parts[0].unionByName(parts[1])


def masked_totals(frame: DataFrame, unit: str, counts: Sequence[str]) -> DataFrame:
    """For each count column: its sum, the rows with any, and the distinct units with any."""
    cells = F.array(*(F.struct(F.lit(c).alias("measure"), F.sum(c).alias("total"), F.count_if(F.col(c) > 0).alias("n_rows"), F.countDistinct(F.when(F.col(c) > 0, F.col(unit))).alias("n_units")) for c in counts))
    return frame.agg(cells.alias("__c")).select(F.inline("__c"))
