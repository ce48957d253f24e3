"""The text pipeline over ``documents``: five stages, each one operator over all the stage before it kept.

Every stage but the last returns the columns of its input. ``run`` writes each stage's rows as
Parquet below the shared folder and reads them again for the next.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm import decontaminate, language_id, packing, quality, simhash
from sluice.llm.common import materialise, remainder
from sluice.queries.registry import table

#: A text stays if its language is one of the learned ones with at least this probability.
LEAST_LANGUAGE_SCORE = 0.5
#: SQL cannot express language models, fingerprints or packing; the tests compare with brute force.
ORACLE_SQL = None


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text is in one of the languages of the labelled rows; text that is NULL or has no letter goes."""
    pieces = language_id.read_pieces(public_tokenizers.path("piece_bpe_32k.model"))
    model = language_id.learn(docs.filter(remainder(F.col("doc_id"), 3) != 1), pieces)
    if not model.languages:  # without labelled rows no language can be refused
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    found = language_id.identify(docs, model, keep=docs.columns)
    found = found.filter((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_LANGUAGE_SCORE))
    return found.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that pass the base measures and every rule of the cascade."""
    judged = quality.judge(docs, keep=docs.columns).filter("kept")
    return judged.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates one row: that with the smallest id, of rows that share it the one
    with the smallest text hash, of equal texts any. NULL ids come last, so they lose to any id."""
    none = F.lit(0).cast(docs.schema["doc_id"].dataType)
    key = F.struct(
        F.col("doc_id").isNull().alias("unnamed"), F.coalesce("doc_id", none).alias("id"), F.xxhash64("text").alias("hash")
    )
    groups = simhash.near_duplicates(docs.select(key.alias("key"), "text"), shingle_words=4, max_bits=4, id_col="key")
    chosen = groups.filter("doc_id = component_id").groupBy(F.col("doc_id").alias("key")).agg(F.count("*").alias("rows"))
    chosen = materialise(chosen, "chosen")
    kept = docs.join(chosen.filter("rows = 1"), key == F.col("key"), "left_semi")
    again = chosen.filter("rows > 1")
    if again.isEmpty():
        return kept
    return kept.union(docs.join(again, key == F.col("key"), "left_semi").dropDuplicates(["doc_id", "text"]))


def without_test_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows with the passages of test items cut out of their texts; ``n_chars`` follows the text, and a row
    without a word left goes."""
    cleaned = decontaminate.remove_items(docs, table(spark, sf_dir, "benchmark"), window=10)
    if "n_chars" in docs.columns:
        cleaned = cleaned.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return cleaned.filter(r"text RLIKE '[^\\x20\\x09-\\x0D]'").select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each text goes: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=0, capacity=2048)


STAGES = [
    ("language_id", known_language),
    ("quality_rules", good_quality),
    ("simhash_near_dedup", one_of_each_group),
    ("benchmark_decontamination", without_test_items),
    ("best_fit_packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        rows = stage(spark, rows, sf_dir)
        if name != STAGES[-1][0]:
            rows = materialise(rows, name)
    return rows
