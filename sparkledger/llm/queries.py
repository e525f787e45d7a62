"""Registered queries of the training-data operators, over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import bpe, chat, decontaminate, html_text, merkle, minhash_join, multi_index, pii, rans, repeats, simhash, spelling, toxicity
from .common import table


def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.formatted(table(spark, sf_dir, "conversations"))


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_join.class_rows(table(spark, sf_dir, "documents"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_rows(table(spark, sf_dir, "documents"))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.bpe_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rans.file_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op8_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multi_index.every_twentieth(table(spark, sf_dir, "embeddings"))


def op9_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.repeat_digests(table(spark, sf_dir, "documents"))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.component_rows(table(spark, sf_dir, "documents"))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.merkle_rows(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_html_text": op1_html_text,
    "op2_toxicity": op2_toxicity,
    "op3_chat": op3_chat,
    "op4_ngram_join": op4_ngram_join,
    "op5_pii": op5_pii,
    "op6_byte_bpe": op6_byte_bpe,
    "op7_token_files": op7_token_files,
    "op8_neighbours": op8_neighbours,
    "op9_repeats": op9_repeats,
    "op10_decontaminate": op10_decontaminate,
    "op11_spelling": op11_spelling,
    "op12_simhash": op12_simhash,
    "op13_merkle": op13_merkle,
}

#: DuckDB SQL for the queries that SQL can express.
ORACLE: dict[str, str] = {
    "op4_ngram_join": minhash_join.ORACLE_SQL,
}
