import random

from test_decontaminate import brute as brute_items
from test_line_dedup import brute as brute_lines
from test_simhash import brute_components, brute_print
from test_toxicity import corpus
from tokenizers import Tokenizer

import corpus_pipeline
from lodestrata.llm import bpe, toxicity


def test_run_matches_brute_force_stage_by_stage(spark, tmp_path):
    rng = random.Random(5)
    texts, labels = corpus(300)
    items = [" ".join(f"q{rng.randrange(50)}" for _ in range(20)) for _ in range(4)]
    line = "this line is boilerplate and long enough"
    texts += [texts[0], texts[1] + "\n" + line, line + "\nnew words here", f"{items[0]} and more", " ".join(items[1].split()[10:] + items[1].split()[:10]), None, "", "  "]
    base = [f"n{rng.randrange(300)}" for _ in range(400)]
    texts += [" ".join(base), " ".join([*base[:200], "changed", *base[201:]])]
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, y) for i, y in enumerate(labels)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    model = toxicity.fit(docs, toxicity.training_rows(spark.read.parquet(f"{tmp_path}/labels.parquet")))
    toxic = {r["record"]["doc_id"] for r in toxicity.score(docs, model).collect() if r["score"] >= 0.5}
    now = [(i, t) for i, t in enumerate(texts) if i not in toxic]
    now = [(i, t) for (i, _), t in zip(now, brute_lines(now), strict=True)]
    groups = brute_components({i: brute_print(t) for i, t in now})
    now = [(i, t) for i, t in now if groups[i] == i]
    held = {r for r, _ in brute_items([t or "" for _, t in now], items)}
    now = [x for n, x in enumerate(now) if n not in held]
    library = Tokenizer.from_file(bpe.default_path())
    expected = {i: library.encode(t or "", add_special_tokens=False).ids for i, t in now}

    found = {r["doc_id"]: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert {i: r["ids"] for i, r in found.items()} == expected
    assert all(r["decoded"] == library.decode(r["ids"], skip_special_tokens=False) for r in found.values())
    assert toxic and held and len(found) > 150


def test_stages_keep_columns_and_survive_odd_rows(spark, make_docs, odd_texts, tmp_path):
    spark.createDataFrame([(1, 0, 1), (2, 0, None)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, None), (None, "a b c d e f g")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    cases = [make_docs([]), make_docs([*enumerate(odd_texts), (None, "x y"), (None, None), (5, "x y"), (5, "x y")])]
    for docs in cases:
        first = docs
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, str(tmp_path))
            assert docs.columns == first.columns and dict(docs.dtypes) == dict(first.dtypes)
        docs = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path))
        assert docs.count() <= first.count()


def test_rows_that_share_an_id_and_odd_column_names(spark, tmp_path):
    rows = [(1, "a wholly different text about rivers and mountains in spring", 5, 6, 7), (1, "nothing of that kind stands here at all today", 8, 9, 10), (2, "another one", 11, 12, 13)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, tie int, row int, `a.b` int")
    assert sorted(map(tuple, corpus_pipeline.drop_near_copies(spark, docs, "").collect())) == sorted(rows)
    labels = spark.createDataFrame([(1, 0, 1), (2, 0, 0)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.drop_toxic(spark, docs, str(tmp_path)).columns == docs.columns
    docs = spark.createDataFrame([(*r, len(r[1])) for r in rows], "doc_id long, text string, tie int, row int, `a.b` int, n_chars long")
    assert corpus_pipeline.drop_repeated_lines(spark, docs, "").columns == docs.columns
