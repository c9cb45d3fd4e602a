"""Registered queries of the operators: thin callers with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from subtide.llm import (
    alignment,
    bpe,
    decontamination,
    html_crf,
    licences,
    mixing,
    oracle,
    quality_ranking,
    quality_rules,
    sharding,
    simhash,
    spelling,
    token_files,
    toxicity,
)
from subtide.llm.frames import held_out, table
from subtide.session import materialized

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
END_ID = 2
SHARDS = 40


def ids_digest(ids: str) -> Column:
    return F.sha2(F.array_join(F.col(ids).cast("array<string>"), ",").cast("binary"), 256)


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = bpe.encode_documents(table(spark, sf_dir, "documents"), TOKENIZER, keep=["doc_id"], decoded=True)
    return rows.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        ids_digest("ids").alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = token_files.token_file_folder(spark)
    token_files.write_token_files(table(spark, sf_dir, "documents"), TOKENIZER, folder, END_ID)
    files = token_files.read_token_files(spark, folder)
    rows = token_files.with_starts(token_files.with_checksums(files), files)
    return rows.select("doc_id", "start", "n_tokens", "ids_crc32")


def op3_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licences.scan(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return found.select("doc_id", "licence", F.round("dice", 6).alias("dice"), "n_units", "n_windows")


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.find_spans(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        decontamination.contaminated().alias("contaminated"),
    )


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


def op6_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return html_crf.extract(pages, html_crf.train(pages), keep=["page_id", "url"]).select("page_id", "url", "text", "n_chars")


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(table(spark, sf_dir, "documents"), SHARDS).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def _scored(scores: DataFrame) -> DataFrame:
    return scores.select("doc_id", held_out("doc_id").alias("held_out"), "score", "predicted")


def op8_quality_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return _scored(quality_ranking.with_scores(docs, quality_ranking.train(docs, labels), keep=["doc_id"]))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text")
    measured = materialized(quality_rules.with_measures(docs).drop("text"), "measures")
    return quality_rules.apply_rules(measured).select("doc_id", *quality_rules.BASE, "base_failed", "kept")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return _scored(toxicity.with_scores(docs, toxicity.train(docs, labels), keep=["doc_id"]))


def op11_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mixing.taken_words(mixing.mix(table(spark, sf_dir, "documents")))
    return rows.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = alignment.alignments(table(spark, sf_dir, "documents"), TOKENIZER, PIECES, keep=["doc_id"])
    return rows.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling.vocabulary(table(spark, sf_dir, "documents"), misspell_every=31)
    return spelling.spelling_groups(words).select("word", "form", "root", "n", "n_near", "form_n")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe": op1_bpe,
    "op2_token_files": op2_token_files,
    "op3_licences": op3_licences,
    "op4_decontamination": op4_decontamination,
    "op5_simhash": op5_simhash,
    "op6_html": op6_html,
    "op7_sharding": op7_sharding,
    "op8_quality_ranking": op8_quality_ranking,
    "op9_quality_rules": op9_quality_rules,
    "op10_toxicity": op10_toxicity,
    "op11_mixing": op11_mixing,
    "op12_alignment": op12_alignment,
    "op13_spelling": op13_spelling,
}


def oracle_sql() -> dict[str, str]:
    return oracle.SQL
