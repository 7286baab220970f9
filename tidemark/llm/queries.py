"""Registered queries of this package: each applies an operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import align, bpe, ctw, dac, decontaminate, exact, jaccard, licences, phrases, quality, sharding, toxicity, warc
from tidemark.llm.common import crc_bucket, table, written
from tidemark.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def add(plan):
        QUERIES[name] = plan
        if oracle:
            ORACLES[name] = oracle
        return plan

    return add


@query("op1_quality_rules", quality.ORACLE)
def quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.judge(table(spark, folder, "documents"), keep=["doc_id"])


@query("op10_sharding")
def shards(spark: SparkSession, folder: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = table(spark, folder, "documents").select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    return sharding.shuffle_to_shards(rows, ["doc_id", "text_crc32", "size"], 8).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


@query("op5_warc")
def warc_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    out = scratch_path(spark, "warc")
    pages = table(spark, folder, "pages")
    files = written(warc.write_archives(pages, out), "warc-files")  # runs the write
    if files.isEmpty():  # no page, no folder
        return spark.createDataFrame([], "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint")
    warc.require_shared(files, out)
    return warc.read_archives(spark, out, html=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op8_byte_bpe")
def byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.tokenize(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, ids=False)


@query("op9_token_output")
def token_output(spark: SparkSession, folder: str) -> DataFrame:
    files = written(dac.write_ids(
        table(spark, folder, "documents"), scratch_path(spark, "dac"), public_tokenizers.path("byte_bpe_50k.json"), end=2),
        "dac-files")
    return dac.read_ids(files)


@query("op4_ngram_jaccard")
def ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, folder, "documents"))


@query("op6_toxicity")
def toxic_scores(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = toxicity.fit(docs, table(spark, folder, "labels"))
    found = toxicity.score(docs, model, keep=["doc_id"])
    return found.select("doc_id", (crc_bucket(F.col("doc_id"), 5) == 0).alias("held_out"), "score", "predicted")


@query("op7_context_tree")
def context_tree(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    found = ctw.score_texts(docs, ~ctw.held_out(F.col("doc_id")))
    return found.withColumn("held_out", ctw.held_out(F.col("doc_id"))).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "n_bytes")


@query("op3_decontamination")
def decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"), parts=True)


@query("op2_license_scan")
def license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licences.scan(table(spark, folder, "documents"))


@query("op11_exact_dedup", exact.ORACLE)
def exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    rows = exact.exact_duplicates(table(spark, folder, "documents"), scratch_path(spark, "exact"))
    return rows.select(
        F.col("key").alias("doc_id"), F.col("keep").alias("keep_id"), F.col("copies").alias("group_size"), "kept",
        F.lower(F.hex("digest")).alias("text_sha256"))


@query("op12_collocations", phrases.ORACLE)
def phrase_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.collocations(table(spark, folder, "documents"))


@query("op13_cross_tokenizer")
def cross_tokenizer(spark: SparkSession, folder: str) -> DataFrame:
    return align.cross_alignment(
        table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"),
        public_tokenizers.PATTERN).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
