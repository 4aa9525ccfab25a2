import math
import random
import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lodestrata.functions.seeds import age_anchors, anchors
from lodestrata.operators import histories, passages, scoring
from lodestrata.operators.contracts import ContractError
from lodestrata.plans.stages import Runner, Stage, select_range


def test_statements(spark):
    text = "Opening line. It goes on.\nAge: 60\nTreatment history: Surgery in 2020; Chemo followed.\nHistology:\nadenocarcinoma. (well differentiated)\n\n"
    rows = histories.statements(spark.createDataFrame([(1, text)], "id int, t string"), "id", "t").orderBy("n").collect()
    assert [(r["n"], r["section"], r["text"]) for r in rows] == [
        (1, "Summary", "Opening line."),
        (2, "Summary", "It goes on."),
        (3, "Age", "Age: 60"),
        (4, "Treatment history", "Surgery in 2020;"),
        (5, "Treatment history", "Chemo followed."),
        (6, "Histology", "adenocarcinoma."),
        (7, "Histology", "(well differentiated)"),
    ]


def test_chunks_carry_dates(spark):
    notes = spark.createDataFrame([(1, 1, "2020", "a b"), (1, 2, "2021", " ".join("wxyz" * 10)), (2, 1, "2019", "short")], "p int, n int, d string, t string")
    rows = histories.chunked(histories.concatenated(notes, "p", "d", ["n"], "t"), "p", 12, 2).orderBy("p", "round").collect()
    assert [(r["first_date"], r["last_date"]) for r in rows if r["p"] == 1][0] == ("2020", "2021")
    assert {(r["first_date"], r["last_date"]) for r in rows if r["p"] == 1 and r["round"] >= 2} == {("2021", "2021")}
    assert rows[-1]["chunk"] == "=== Clinical Note dated 2019 ===\nshort\n" and rows[-1]["round"] == 0


def test_serial_fold(spark):
    chunks = spark.createDataFrame([("a", 2, "y"), ("a", 1, "x"), ("b", 1, "z")], "p string, n int, t string")
    found = histories.fold_rounds(chunks, "p", "n", lambda s, c: (s or "") + c, "t").collect()
    assert sorted(map(tuple, found)) == [("a", "xy", 2), ("b", "z", 1)]


@pytest.mark.parametrize(
    ("seed", "diagnoses", "others", "intervals"),
    [
        ("Diagnosed at 50 years and 2 weeks; started chemo at age 51 years and 0 weeks.", {(50, 2)}, {(51, 0)}, 0),
        ("At age 40 years and 1 weeks, she received surgery.", set(), {(40, 1)}, 0),
        ("At age 40 years and 1 weeks, diagnosis of cancer.", {(40, 1)}, set(), 0),
        ("Diagnosed at 61 years and 3 weeks, recurred at 2 years and 0 weeks.", {(61, 3)}, set(), 1),
        ("Diagnosed at 61 years and 3 weeks. Scan at age 2 years and 0 weeks.", {(61, 3)}, {(2, 0)}, 0),
    ],
)
def test_age_anchors(seed, diagnoses, others, intervals):
    assert age_anchors(seed) == (diagnoses, others, intervals)


def test_malformed_ages(spark):
    for seed in ("no ages", "at 50 years", "at 50.5 years and 2 weeks", "aged 50 years and 60 weeks", "at -5 years and 1 weeks"):
        with pytest.raises(ValueError):
            age_anchors(seed)
    rows = spark.createDataFrame([("Diagnosed at 5 years and 2 weeks",), (None,)], "s string").select(anchors(F.col("s")).alias("a")).select("a.*").collect()
    assert rows[0]["diagnoses"] == ["5+2"] and rows[1]["error"]


def brute_passages(text, criterion, top=3):
    lines = [(i, set(re.findall(r"[\w]+", x.lower()))) for i, x in enumerate(text.split("\n")) if x.strip()]
    df = {}
    for _, s in lines:
        for t in s:
            df[t] = df.get(t, 0) + 1
    idf = {t: math.log((len(lines) + 1) / (c + 1)) + 1 for t, c in df.items()}
    asked = set(re.findall(r"[\w]+", criterion.lower()))
    total = sum(idf.get(t, math.log(len(lines) + 1) + 1) for t in asked)
    runs = []
    for k in range(len(lines)):
        for n in range(1, min(3, len(lines) - k) + 1):
            own = set().union(*(s for _, s in lines[k : k + n]))
            found = sum(idf[t] for t in own & asked)
            if found:
                runs.append((-round(found / total, 2), n, -round(found / sum(idf[t] for t in own), 3), k))
    used, out = set(), []
    for s, n, _, k in sorted(runs):
        if used.isdisjoint(range(k, k + n)) and len(out) < top:
            used.update(range(k, k + n))
            out.append((len(out) + 1, lines[k][0], n, -s))
    return out


def test_passages_against_brute_force(spark):
    rng = random.Random(8)
    docs = [(i, "\n".join(" ".join(rng.choice("abcdefghijkl") for _ in range(rng.randint(0, 5))) for _ in range(rng.randint(1, 25)))) for i in range(25)]
    asked = [(i, j, " ".join(rng.choice("abcdefghijklz") for _ in range(5))) for i, _ in docs for j in range(2)]
    found = passages.best_passages(spark.createDataFrame(docs, "d int, t string"), spark.createDataFrame(asked, "d int, c int, q string"), "d", "t", "c", "q").collect()
    texts = dict(docs)
    expected = sorted((i, j, *p) for i, j, q in asked for p in brute_passages(texts[i], q))
    assert sorted((r["d"], r["c"], r["place"], r["first_line"], r["n_lines"], round(r["score"], 2)) for r in found) == [(*e[:5], round(e[5], 2)) for e in expected]


def test_scorer_retries_and_reports(spark):
    rows = spark.createDataFrame([("a",), ("a",), ("bad",), ("boom",)], "t string").repartition(1)

    def scorer(batch: pd.DataFrame):
        if (batch["t"] == "boom").all():
            raise RuntimeError("down")
        return [None if t == "bad" else len(t) for t in batch["t"]]

    found = {r["t"]: (r["n"], r["n_error"]) for r in scoring.scored(rows, ["t"], scorer, "n", "double", valid=lambda v: v < 3).collect()}
    assert found["a"] == (1.0, None) and found["bad"] == (None, "not valid") and found["boom"][0] is None
    assert scoring.scored(rows, ["t"], scorer, "n", "double").count() == 4
    units = scoring.encoded(rows, "t", lambda ts: np.array([[len(t), 0.0] for t in ts])).collect()
    assert units[0]["vector"] == [1.0, 0.0]


def test_stages_resume(spark, tmp_path):
    ran = []

    def make(name, n):
        def run(session, inputs):
            ran.append(name)
            base = list(inputs.values())
            return base[0].limit(n) if base else session.range(n).toDF("a")

        return run

    stages = [Stage("one", make("one", 5), (), {"n": 5}), Stage("two", make("two", 3), ("one",))]
    runner = Runner(spark, f"file://{tmp_path}")
    assert runner.run(stages) == ["one", "two"] and runner.run(stages) == [] and ran == ["one", "two"]
    assert runner.table("two").count() == 3
    with pytest.raises(ContractError, match="differ"):
        runner.run([Stage("one", make("one", 6), (), {"n": 6})])
    assert [s.name for s in select_range(stages, "two")] == ["two"]
    with pytest.raises(ContractError):
        select_range(stages, "two", "one")
