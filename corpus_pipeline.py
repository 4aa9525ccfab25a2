"""A corpus pipeline of five stages: each gets the table that the one before it wrote.

toxicity (rejected documents go), line dedup (repeated lines go), near-dedup (one document of each
group of Jaccard 0.8 stays), benchmark decontamination (documents that hold an item go), BPE.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrata.llm import bpe, decontaminate, line_dedup, near_copies, toxicity
from lodestrata.llm.storage import written

#: No SQL: word splitting, fingerprints, tiles and BPE have none; tests hold the pipeline against brute force.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score says non-toxic; a null text is scored like an empty one."""
    model = toxicity.fit(docs, toxicity.training_rows(spark.read.parquet(f"{sf_dir}/labels.parquet")))
    return toxicity.score(docs, model, evidence=0).where(F.col("score") < 0.5).select("record.*")


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without runs of lines that stand earlier, short lines and all; n_chars follows the text."""
    return line_dedup.deduplicated(docs).withColumn("n_chars", F.char_length("text").cast("long")).select(*(F.col(f"`{c}`") for c in docs.columns))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group, the first by id, hash of the text and hash of the row; documents without an id stay.

    A group: texts whose sets of five-word shingles have a Jaccard similarity of 0.8 or more, and chains of
    them. An id that several texts share links nothing: each of its texts is a document.
    """
    columns = [F.col(f"`{c}`") for c in docs.columns]
    known = docs.where("doc_id IS NOT NULL").select(F.struct(*columns).alias("record"), "doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("tie"), F.xxhash64(*columns).alias("row"))
    firsts = known.groupBy("tie").agg(F.min(F.struct("doc_id", "tie", "row")).alias("first"))
    groups = near_copies.near_copies(known.select("tie", "text"), "tie").distinct()
    kept = firsts.join(groups, "tie").groupBy("component").agg(F.min("first").alias("first")).select("first.*")
    one = known.join(kept, ["doc_id", "tie", "row"], "left_semi").dropDuplicates(["doc_id", "tie", "row"])
    return one.select("record.*").unionByName(docs.where("doc_id IS NULL"))


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return decontaminate.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids and the text that the ids decode to."""
    return bpe.encode(docs, decoded=True, block_bytes=6 << 20).select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded")


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_benchmark),
    ("BPE encoding and decoding", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; every stage but the last is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = written(docs, f"pipeline-{number}")
    return docs
