import random

from oracle import duck_rows, spark_rows

import corpus_pipeline
from lodestrata.llm import line_dedup, queries


def brute(rows, min_chars=line_dedup.MIN_CHARS):
    """Kept texts, by remembering every run of any number of lines in order."""
    seen, out = set(), []
    for _, text in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        lines, gone = (text or "").split("\n"), set()
        for p in range(len(lines)):
            for n in range(1, min(60, len(lines) - p) + 1):  # longer runs are chains of these
                run = tuple(lines[p : p + n])
                if sum(map(len, run)) >= min_chars:
                    if run in seen:
                        gone.update(range(p, p + n))
                    seen.add(run)
        out.append(None if text is None else "\n".join(x for i, x in enumerate(lines) if i not in gone))
    return out


def line_texts(seed=1, n=60):
    rng = random.Random(seed)
    pool = ["".join(rng.choice("ab ") for _ in range(rng.randint(0, 30))) for _ in range(25)]
    return ["\n".join(rng.choice(pool) if rng.random() < 0.7 else f"own {rng.random()}" for _ in range(rng.randint(1, 12))) for _ in range(n)]


def test_against_brute_force(make_docs, odd_texts):
    texts = odd_texts + line_texts() + [None, ""]
    docs = make_docs(texts)
    rows = {r["doc_id"]: r for r in line_dedup.deduplicated(docs).collect()}
    assert [rows[i]["text"] for i in range(len(texts))] == brute(list(enumerate(texts)))
    for i, t in enumerate(texts):
        before, after = (t or "").split("\n"), (rows[i]["text"] or "").split("\n")
        assert rows[i]["line_dedup"]["n_lines"] == (0 if t is None else len(before))
        assert rows[i]["line_dedup"]["n_removed"] in (len(before) - len(after), len(before))


def test_extra_columns_stay(make_docs):
    docs = make_docs(["a", "b"])
    assert line_dedup.deduplicated(docs).columns == [*docs.columns, "line_dedup"]


def test_null_and_repeated_ids(make_docs):
    line = "a line that is long enough"
    found = line_dedup.deduplicated(make_docs([(None, line), (4, line), (4, line), (9, line)])).collect()
    assert sorted((str(r["doc_id"]), r["text"]) for r in found) == [("4", line), ("4", line), ("9", ""), ("None", "")]
    assert line_dedup.deduplicated(make_docs([])).count() == 0


def test_no_python_in_the_plan(make_docs):
    plan = line_dedup.deduplicated(make_docs(["a"]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_query_equals_sql(spark, make_docs, tmp_path, odd_texts):
    pool = ["", "a", "bb", "été", "four", "sixsix", "日本語テキスト", "a line that is long enough"]
    short = ["\n".join(random.Random(i).choice(pool) for _ in range(i % 25)) for i in range(60)]
    make_docs(odd_texts + line_texts(2) + short).write.parquet(f"{tmp_path}/documents.parquet")
    assert spark_rows(queries.op3_line_dedup(spark, str(tmp_path))) == duck_rows(line_dedup.ORACLE, str(tmp_path))


def test_runs_of_short_lines(spark, make_docs):
    verse = "\n".join(["roses", "are", "", "red", "\u2028 é\r", "violets", "are", "blue", "x"])
    rng = random.Random(11)
    pool = ["", "a", "bb", "été", "four", "fifth", "sixsix", "日本語テキスト", "a line that is long enough", "\r", "x" * 12]
    short = ["\n".join(rng.choice(pool) for _ in range(rng.randint(1, 25))) for _ in range(60)]
    texts = [verse, f"own\n{verse}\nother", "\n\n\n" + verse, *short, None, "", "\n" * 40, "ab\n" * 40, *line_texts(3, 30)]
    found = {r["doc_id"]: r["text"] for r in corpus_pipeline.drop_repeated_lines(spark, make_docs(texts), "").collect()}
    assert found[1] == "own\nother"
    assert [found[i] for i in range(len(texts))] == brute(list(enumerate(texts)))


def test_short_lines_that_others_share(make_docs):
    short = "\n".join(chr(97 + i) * (i % 5 + 1) for i in range(26))
    found = {r["doc_id"]: r for r in line_dedup.deduplicated(make_docs([short, short, f"x\n{short}"])).collect()}
    assert [found[i]["line_dedup"]["n_removed"] for i in range(3)] == [0, 26, 26] and found[2]["text"] == "x"


def test_short_last_lines_of_copies(make_docs):
    rng = random.Random(5)
    texts = []
    for _ in range(40):  # a short line ends each run; it is the fingerprint of no window ahead
        text = "\n".join("".join(rng.choice("abcdefgh ") for _ in range(rng.randint(25, 60))) for _ in range(rng.randint(1, 4))) + f"\nend {rng.randrange(10**4)}"
        texts += [text, text, text + "\nand another line that is long enough"]
    found = {r["doc_id"]: r["text"] for r in line_dedup.deduplicated(make_docs(texts)).collect()}
    assert [found[i] for i in range(len(texts))] == brute(list(enumerate(texts)))
