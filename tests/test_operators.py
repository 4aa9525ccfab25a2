import math
import random

import pytest
from pyspark.sql import functions as F

from lodestrata.operators import contracts, dedup, joins, metrics, ranking, sampling, windows
from lodestrata.operators.contracts import ContractError


def test_validated_join_and_reconcile(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    b = spark.createDataFrame([(1, "p"), (1, "q")], "k int, w string")
    with pytest.raises(ContractError):
        contracts.validated_join(a, b, ["k"], cardinality="many_to_one")
    assert contracts.validated_join(a, b, ["k"], cardinality="one_to_many").count() == 2
    assert contracts.reconcile(a, a.withColumn("z", F.lit(1)), ["k"]).columns == ["k", "v", "z"]
    with pytest.raises(ContractError):
        contracts.reconcile(a, a.withColumn("v", F.lit("other")), ["k"])


def test_numbered_sets(spark):
    rows = [("a", 0, 2, "yes", "t", "s"), ("a", 1, 2, "yes", "t", "s"), ("b", 0, 1, "no", "t", "s"), ("c", 1, 1, "no", "t", "s"), ("d", 0, 2, "no", " ", "s"), ("d", 1, 2, "yes", "t", "z"), ("e", 0, 1, None, "t", "s")]
    frame = spark.createDataFrame(rows, "g string, number int, count int, multiple string, text string, split string")
    found = {tuple(r) for r in contracts.numbered_set_violations(frame, ["g"], "number", "count", "multiple", "text", "split").collect()}
    assert found == {("c", "numbers"), ("d", "text"), ("d", "split"), ("d", "multiple"), ("e", "flag")}


def test_changed_rows_and_missing(spark):
    a = spark.createDataFrame([(1, "x"), (2, None), (3, "z")], "k int, v string")
    b = spark.createDataFrame([(1, "x"), (2, None), (4, "z")], "k int, v string")
    assert sorted(r[0] for r in contracts.changed_rows(a, b, ["k"], ["v"]).collect()) == [3, 4]
    assert [r[0] for r in contracts.missing_keys(a, b, ["k"]).collect()] == [3]
    assert contracts.changed_rows(a, a, ["k"], ["v"]).count() == 0


def test_prior_counts_against_naive(spark):
    rng = random.Random(1)
    events = [(i, rng.randrange(5), rng.randrange(20)) for i in range(60)]
    reports = [(rng.randrange(6), rng.randrange(20) if rng.random() > 0.1 else None) for _ in range(200)]
    found = joins.prior_counts(spark.createDataFrame(events, "e int, p int, cutoff int"), spark.createDataFrame(reports, "p int, at int"), "p", "cutoff", "at").collect()
    assert {r["e"]: r["n_prior"] for r in found} == {e: sum(q == p and d is not None and d < c for q, d in reports) for e, p, c in events}


def test_running_totals_against_naive(spark):
    rng = random.Random(2)
    rows = [(i * rng.choice([1, 1]) + 0.5, rng.randrange(9)) for i in range(500)]
    found = windows.running_totals(spark.createDataFrame(rows, "s double, v long").repartition(7), "s", ["v"], buckets=8).collect()
    total, expected = 0, {}
    for s, v in sorted(rows):
        total += v
        expected[s] = total
    assert {r["s"]: r["cum_v"] for r in found} == expected


def test_monotone_offsets(spark):
    rows = [(0, 5), (1, 3), (2, 4), (3, 20), (4, 20)]
    frame = spark.createDataFrame(rows, "n int, o int").withColumn("g", F.lit(1))
    found = frame.select("n", windows.monotone_offsets(F.col("o"), ["g"], [F.col("n")]).alias("x")).orderBy("n").collect()
    assert [r["x"] for r in found] == [5, 6, 7, 20, 21]


def test_metrics_against_definitions(spark):
    rng = random.Random(3)
    rows = [(int(rng.random() < 0.4), round(rng.random(), 1), rng.choice([1.0, 2.0])) for _ in range(200)]
    frame = spark.createDataFrame(rows, "y int, p double, w double")
    pairs = [(a, b) for a in rows for b in rows if a[0] and not b[0]]
    win = lambda a, b: 1.0 if a[1] > b[1] else 0.5 if a[1] == b[1] else 0.0
    assert metrics.auroc(frame, "y", "p").first()[0] == pytest.approx(sum(win(a, b) for a, b in pairs) / len(pairs))
    weight = sum(a[2] * b[2] for a, b in pairs)
    assert metrics.auroc(frame, "y", "p", "w").first()[0] == pytest.approx(sum(win(a, b) * a[2] * b[2] for a, b in pairs) / weight)
    assert metrics.auroc(frame.where("y = 1"), "y", "p").first()[0] is None
    ap, tp, seen = 0.0, 0, 0
    for s in sorted({r[1] for r in rows}, reverse=True):
        new = [r for r in rows if r[1] == s]
        tp, seen = tp + sum(r[0] for r in new), seen + len(new)
        ap += sum(r[0] for r in new) * tp / seen
    assert metrics.average_precision(frame, "y", "p").first()[0] == pytest.approx(ap / tp)


def test_calibration_fit_recovers_a_shift(spark):
    rng = random.Random(4)
    rows = []
    for _ in range(6000):
        x = rng.gauss(0, 1.5)
        rows.append((int(rng.random() < 1 / (1 + math.exp(-(x + 0.8)))), 1 / (1 + math.exp(-x))))
    intercept, slope = metrics.calibration_fit(spark.createDataFrame(rows, "y int, p double"), "y", "p")
    assert abs(intercept - 0.8) < 0.15 and abs(slope - 1) < 0.15
    assert math.isnan(metrics.calibration_fit(spark.createDataFrame([(1, 0.5)], "y int, p double"), "y", "p")[0])


def test_similarity_in_small_blocks(spark):
    rng = random.Random(5)
    vectors = [(i, [rng.gauss(0, 1) for _ in range(8)]) for i in range(60)]
    frame = spark.createDataFrame([*vectors, (99, None)], "id long, v array<double>").repartition(3)
    whole = ranking.similar_top_k(frame.where("id < 7"), frame, "id", "v", 4).collect()
    blocks = ranking.similar_top_k(frame.where("id < 7"), frame, "id", "v", 4, block_bytes=130).collect()
    assert sorted(map(tuple, whole)) == sorted(map(tuple, blocks)) and len(whole) == 28


def test_sampling_helpers(spark):
    assert sampling.round_robin_allocation({"a": 1, "b": 10, "c": 3}, 8) == {"a": 1, "b": 4, "c": 3}
    assert sampling.largest_remainder([3, 3, 1], 4) == [2, 2, 0] or sum(sampling.largest_remainder([3, 3, 1], 4)) == 4
    assert sampling.contiguous_ranges(7, 3) == [(0, 3), (3, 5), (5, 7)]
    assert sampling.pack_first_fit([5, 9, 4, 1, 30], 10) == [[4], [1, 3], [0, 2]]  # a row beyond a bin has one by itself
    bins = sampling.packed_bins(spark.range(100).withColumn("n", F.col("id") % 7 + 1), "id", "n", 10, 30).groupBy("window", "bin").agg(F.sum(F.col("id") % 7 + 1).alias("s")).collect()
    assert max(r["s"] for r in bins) <= 10


def test_dedup_rules(spark):
    frame = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "k int, v string")
    assert dedup.distinct_or_conflict(frame, ["k"]).count() == 2
    with pytest.raises(ContractError):
        dedup.distinct_or_conflict(frame.unionByName(frame.withColumn("v", F.lit("z"))), ["k"])
    notes = spark.createDataFrame([(1, 1, "One. Two! Three?"), (1, 2, "Two! Four."), (1, 3, "One."), (2, 1, "One.")], "p int, n int, t string")
    assert sorted(map(tuple, dedup.first_sentences(notes, "p", ["n"], "t").collect())) == [(1, 1, "One. Two! Three?"), (1, 2, "Four."), (2, 1, "One.")]
