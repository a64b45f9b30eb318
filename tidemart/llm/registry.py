"""The corpus operators as named queries over the test tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm import (
    chat,
    divergence,
    exact_dedup,
    fingerprints,
    licenses,
    merkle,
    mixing,
    packing,
    sharding,
    simhash_trees,
    token_files,
    toxicity,
    url_reputation,
)
from tidemart.llm.oracle import ORACLE_SQL
from tidemart.llm.work import table, text_of

__all__ = ["ORACLE_SQL", "QUERIES"]

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
END_ID = 1


def held_out() -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0


def fitted(spark: SparkSession, folder: str) -> toxicity.Model:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    return toxicity.fit(docs, labels.where(~held_out()).select("doc_id", "toxic"))


def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    model = fitted(spark, folder)
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return toxicity.scored(docs, model, "score", drop=("text",)).select(
        "doc_id",
        F.coalesce(held_out(), F.lit(False)).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )


def op2_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(table(spark, folder, "documents"))


def op3_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.taken_words(mixing.schedule(table(spark, folder, "documents")))


def op4_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    # more ranges than tasks, so that tasks get about as many each
    parts = 8 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = fingerprints.compare_edited(table(spark, folder, "documents"), parts)
    hex_of = lambda c: F.lower(F.lpad(F.hex(c), 16, "0"))
    return found.select(
        "doc_id", "n_chars", "edited_sha256", hex_of("fp").alias("fingerprint"),
        hex_of("edited_fp").alias("edited_fingerprint"), "near_edited", "near_next",
    )


def op5_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed(table(spark, folder, "documents"))


def op6_chat(spark: SparkSession, folder: str) -> DataFrame:
    records = table(spark, folder, "conversations").select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    test = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]
    records = records.union(spark.createDataFrame(test, records.schema))
    turns = chat.canonical(records, fields=("role", "text")).select("conv_id", "turn", F.posexplode("turns").alias("at", "_t"))
    chats = chat.formatted(turns.select("conv_id", "turn", "at", "_t.*"), "conv_id", ["turn", "at"])
    return chat.digests(chats, "conv_id")


def op7_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    dedup = exact_dedup.ExactDedup(spark)
    dedup.feed(docs)
    return dedup.decisions(docs).select(
        "doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256")
    )


def op8_token_files(spark: SparkSession, folder: str) -> DataFrame:
    path = token_files.write(table(spark, folder, "documents"), TOKENIZER, END_ID)
    return token_files.index(spark, path)


def op9_urls(spark: SparkSession, folder: str) -> DataFrame:
    # a page's outcome is the label of the document of the same number
    bad = ((F.col("toxic") == 1) | (F.col("quality") == 0)).cast("int").alias("bad")
    outcomes = table(spark, folder, "labels").select(F.col("doc_id").alias("page_id"), bad)
    return url_reputation.judged(table(spark, folder, "pages"), outcomes).drop("bad_rate_low")


def op10_simhash_trees(spark: SparkSession, folder: str) -> DataFrame:
    return simhash_trees.near_components(table(spark, folder, "documents")).select(
        "doc_id", simhash_trees.hex_print().alias("fingerprint"), "component_id"
    )


def op11_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.audit(table(spark, folder, "documents"))


def op12_manifest(spark: SparkSession, folder: str) -> DataFrame:
    altered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    docs = table(spark, folder, "documents")
    found = merkle.manifest(docs, changed={"n_chars": F.try_add("n_chars", F.lit(1))}, where=altered)
    return found.select(
        "doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("path")).alias("proof_sha256"), "folded_root",
        "verified",
    )


def op13_sharding(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    weights = (1,) * sharding.SHARDS
    placed = sharding.read(spark, sharding.write(docs, weights), docs.schema)
    text = text_of().cast("binary")
    return placed.select(
        "doc_id",
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.lit("key").alias("law"),
        "shard",
        "slot",
        sharding.shard_of(sharding.key_of(), (*weights, 1)).alias("grown_shard"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    fn.__name__: fn
    for fn in (
        op1_toxicity, op2_licenses, op3_mixing, op4_fingerprints, op5_packing, op6_chat, op7_exact_dedup,
        op8_token_files, op9_urls, op10_simhash_trees, op11_divergence, op12_manifest, op13_sharding,
    )
}
