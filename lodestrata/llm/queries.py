"""The registered queries of the training-data operators: one thin query for each."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, decontaminate, gif_media, line_dedup, secret_scan, shuffle_shards, simhash, substring_dedup, token_blocks, toxicity
from .storage import written, written_path


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: counts by kind and digests of the spans."""
    found = secret_scan.scan_secrets(_documents(spark, sf_dir))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("spans", lambda s: s["kind"].isin(*secret_scan.BASE_KINDS))
    return found.select(
        "doc_id",
        *(count(kind).alias(f"n_{kind}") for kind in secret_scan.BASE_KINDS),
        F.sha2(secret_scan.span_digest(base), 256).alias("base_sha256"),
        secret_scan.span_digest(F.col("spans")).alias("spans"),
    )


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document from its nearest labelled examples."""
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    model = toxicity.fit(docs, toxicity.training_rows(spark.read.parquet(f"{sf_dir}/labels.parquet")))
    found = toxicity.score(docs, model)
    held_out = F.coalesce(F.crc32(F.col("record.doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    evidence = F.concat_ws(",", F.transform("evidence", lambda e: F.concat_ws(":", e["doc_id"].cast("string"), F.format_number(e["cosine"], 4))))
    return found.select("record.doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), evidence.alias("evidence"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of every document that stand earlier, deleted in runs."""
    found = line_dedup.deduplicated(_documents(spark, sf_dir).select("doc_id", "text"))
    return found.select("doc_id", "line_dedup.n_lines", "line_dedup.n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op4_token_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document, written as packed blocks and read back."""
    out = written_path(spark, "token-blocks")
    token_blocks.write_tokens(_documents(spark, sf_dir), out)
    return token_blocks.read_tokens(spark, out).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items that each document holds, by greedy string tiling."""
    found = decontaminate.benchmark_hits(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    items = F.array_sort(F.transform("hits", lambda h: h["item"]))
    return found.select(
        "doc_id",
        (F.size("hits") > 0).alias("contaminated"),
        F.size("hits").cast("long").alias("n_items"),
        F.concat_ws(",", items.cast("array<string>")).alias("items"),
        F.round(F.coalesce(F.array_max(F.transform("hits", lambda h: h["coverage"])), F.lit(0.0)), 6).alias("coverage"),
    )


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document and the text decoded from them."""
    found = bpe.encode(_documents(spark, sf_dir), decoded=True)
    ids = F.concat_ws(" ", F.col("ids").cast("array<string>"))
    return found.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op7_gif_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document stored as a GIF, read back, with features of its frames."""
    stored = written(gif_media.store_texts(_documents(spark, sf_dir)), "gif-media")
    # each file is decoded where it is read; its digest travels with it as the id
    read = gif_media.media_columns(stored.select(F.struct("doc_id", "n_bytes", F.octet_length("media").cast("long").alias("media_bytes"), F.sha2("media", 256).alias("media_sha256")).alias("key"), "media"), "key")
    bins = F.aggregate("frames", F.array_repeat(F.lit(0).cast("long"), gif_media.BINS), lambda acc, f: F.zip_with(acc, F.slice(f["histogram"], 1, gif_media.BINS), lambda a, b: a + b))
    shown = F.aggregate("frames", F.lit(0), lambda acc, f: acc + f["delay_ms"])
    return read.select(
        "key.doc_id",
        "key.n_bytes",
        F.octet_length("samples").cast("long").alias("payload_bytes"),
        F.sha2("samples", 256).alias("payload_sha256"),
        F.crc32(F.expr("substring(samples, -16, 16)")).alias("tail_crc32"),
        "key.media_bytes",
        "key.media_sha256",
        F.concat_ws(":", F.size("frames").cast("string"), shown.cast("string"), F.concat_ws(",", bins.cast("array<string>"))).alias("feature"),
    )


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that repeat an earlier document's window of 50."""
    found = substring_dedup.repeated_spans(_documents(spark, sf_dir))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select("doc_id", "n_words", removed.alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"))


def op9_shuffle_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents dealt into 24 shards by their ids, shuffled, written and read back."""
    out = written_path(spark, "shards")
    schema = shuffle_shards.write_shards(_documents(spark, sf_dir), out)
    text = F.coalesce(F.col("record.text"), F.lit(""))
    size = (F.octet_length(text) + shuffle_shards.OVERHEAD).cast("long").alias("size")
    found = shuffle_shards.slots(shuffle_shards.read_shards(spark, out, schema), F.col("record.doc_id").alias("doc_id"), size, F.crc32(text.cast("binary")).alias("text_crc32"))
    return found.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", F.col("slot").cast("long").alias("slot"), shuffle_shards.shard_of(F.col("doc_id"), 25).alias("grown_shard"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash components of all documents."""
    found = simhash.near_duplicates(_documents(spark, sf_dir))
    return found.select("doc_id", simhash.hex_print(F.col("fingerprint")).alias("fingerprint"), "component_id")


def queries() -> dict:
    """Every query of the subpackage by its registered name."""
    return {f.__name__: f for f in (op1_secret_scan, op2_toxicity, op3_line_dedup, op4_token_blocks, op5_decontaminate, op6_bpe, op7_gif_media, op8_substring_dedup, op9_shuffle_shards, op10_simhash)}


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL for the queries that SQL can express on whole tables."""
    return {"op3_line_dedup": line_dedup.ORACLE}
