"""Corpus pipeline over ``documents``: toxicity, near duplicates, benchmark
passages, personal data, tokens.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor
kept; all but the last return the columns they got.  Null and empty texts stay
to the end (as documents without tokens); extra columns pass through.  Rows that
repeat a doc_id with another text are documents of their own; of rows that
repeat both the second stage keeps one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkledger.llm import bpe, decontaminate, minhash_join, pii, toxicity
from sparkledger.llm.common import ship_package, table, written
from sparkledger.llm.repeats import NO_DOC

#: Keys of a row, under names that no input has: its id without nulls and the hash of its text.
KEYS = ("__row_id", "__text_hash")


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.withColumns({
        KEYS[0]: F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_DOC)),
        KEYS[1]: F.xxhash64(F.coalesce("text", F.lit(""))),
    })


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below the threshold; the score is learnt on the labelled ones among them."""
    labels = table(spark, sf_dir, "labels")
    model = toxicity.character_model(docs)
    fitted = toxicity.fit(docs, labels, model)
    return docs.where(toxicity.score(docs, model, fitted) < toxicity.THRESHOLD)


def one_per_class(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates the document of least doc_id."""
    ship_package(spark)
    heads = minhash_join.similarity_classes(docs).select(F.col("class_dk").alias(KEYS[0]), F.col("class_th").alias(KEYS[1])).distinct()
    single = _keyed(docs).groupBy(*KEYS).agg(F.min(F.struct(*docs.columns)).alias("row"))
    return single.join(heads, list(KEYS), "left_semi").select("row.*")


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    found = decontaminate.contaminated(docs, table(spark, sf_dir, "benchmark"), verbatim=True)
    found = found.select(F.col("dk").alias(KEYS[0]), F.col("th").alias(KEYS[1])).distinct()
    return _keyed(docs).join(found, list(KEYS), "left_anti").select(*docs.columns)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every span of personal data replaced by its kind; n_chars follows the text."""
    ship_package(spark)
    hide = pii.redactor(docs, pii.fit(docs))
    out = docs.withColumn("text", hide("text"))
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, n_bytes): ids as little-endian unsigned 32-bit integers, and the bytes they decode to."""
    ship_package(spark)
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    done = bpe.bpe_round_trip(docs, path)
    return done.select("doc_id", F.expr("cast(octet_length(ids) div 4 as long)").alias("n_tokens"), "ids", F.octet_length("decoded").cast("long").alias("n_bytes"))


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_join", one_per_class),
    ("decontaminate", drop_leaks),
    ("pii", redact),
    ("byte_bpe", tokens),
]

#: The models of the stages cannot be written in SQL; tests hold the run against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
