"""Registered queries of the text operators, each over its whole table.

A query applies its operator with production parameters and derives the
digest columns from the operator's output.
"""

from __future__ import annotations

import os

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_path
from . import (ann_forest, byte_bpe, decontaminate, host_quality, html_layout, lexical_search, license_scan,
               line_dedup, merkle_manifest, minhash_dedup, slot_sharding, toxicity, url_equivalence)
from .oracle import ORACLE_SQL  # noqa: F401  (read by the entry module)

QUERIES = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def tokenizer(spark: SparkSession) -> byte_bpe.Tokenizer:
    return byte_bpe.Tokenizer(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"),
                              public_tokenizers.PATTERN)


@query
def op2_host_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its measures, base verdict, its host's shrunk failure rate, kept."""
    judged = host_quality.host_quality(table(spark, sf_dir, "documents"))
    return judged.select("row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                         "n_repeat_words", "base_failed", "kept", "host",
                         F.round("host_rate", 6).alias("host_rate"), "host_rejected")


@query
def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: number and digest of its token ids, digest of the decoded bytes."""
    coder = tokenizer(spark)
    ids = table(spark, sf_dir, "documents").select("doc_id", coder.encode(F.col("text")).alias("ids"))
    both = ids.select("doc_id", "ids", coder.decode(F.col("ids")).alias("decoded"))
    return both.select("doc_id", byte_bpe.n_tokens(F.col("ids")).alias("n_tokens"),
                       F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op4_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: size of its shingle set, its class, its component and whether it stays."""
    return minhash_dedup.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its words, those inside benchmark windows, the items met, the verdict."""
    judged = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return judged.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                         F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


@query
def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its lines, how many an earlier line stands for, digest of what is left."""
    cut = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return cut.select("row.doc_id", "n_lines", "n_dropped", F.sha2("cut_text", 256).alias("text_sha256"))


#: The rules of the URL query.
URL_RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
             ("allow", "com", "/fr/"), ("block", "com", "/de/")]

SHARDS = 24


@query
def op5_url_equivalence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per page: host, path, the rule that fits, the verdict, the least alias."""
    judged = url_equivalence.judge(table(spark, sf_dir, "pages"), URL_RULES)
    return judged.select("row.page_id", "host", "path", "rule", "verdict", "alias_of")


@query
def op8_slot_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its bytes, checksum, shard and place in the shard; shards hold near equal bytes."""
    put = slot_sharding.shard(table(spark, sf_dir, "documents"), shared_path(spark, "shard-map"), SHARDS)
    return put.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                      F.col("position").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
                      F.col("slot").alias("virtual_slot"))


@query
def op1_html_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per page: the text that a reader sees, laid out, and its number of lines."""
    pages = table(spark, sf_dir, "pages").select("page_id", "html")
    return html_layout.extract(pages).select("page_id", "text", F.size(F.split("text", "\n")).alias("n_lines"))


@query
def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: number of licence matches, the licences, the words at which they stand."""
    found = license_scan.with_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.size("licenses").alias("n_matches"),
                        F.array_join(F.array_sort(F.array_distinct("licenses.license")), ",").alias("licenses"),
                        F.array_join("licenses.start", ",").alias("starts"),
                        F.round(F.array_min("licenses.contained"), 6).alias("least_contained"))


@query
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: whether it was held out of training, its score, the predicted label."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.with_scores(docs, table(spark, sf_dir, "labels"), into="score")
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


#: Rows whose id this divides are the queries of the vector search.
ASKED = 50


@query
def op11_ann_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per query vector: its five nearest rows found by the forest, with exact cosines."""
    return ann_forest.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % ASKED == 0, k=5)


#: Rows whose checksum this divides were tampered with in the manifest query.
TAMPERED = 7


@query
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its leaf, subroot and root, the digest of its proof, and whether its row now still verifies."""
    changed = F.crc32(F.col("doc_id").cast("string")) % TAMPERED == 0
    return merkle_manifest.audit(table(spark, sf_dir, "documents"), changed)


@query
def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per benchmark item: its ten highest-scoring documents."""
    return lexical_search.search(table(spark, sf_dir, "benchmark"), table(spark, sf_dir, "documents"), k=10)


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of the documents that the corpus pipeline keeps."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)
