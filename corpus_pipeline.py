"""Documents to token ids: quality, near duplicates, benchmark decontamination, personal data, encoding.

Every stage takes what its predecessor kept and returns the columns of documents; the last one returns token ids.
Rows without a doc_id cannot be named by the decisions of stages two and three and pass them.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.llm import (
    op3_surrogates,
    op4_discriminant,
    op8_templates,
    op9_merge_replay,
    op10_signature_trees,
)
from tripmill.llm.common import crc_mod, free_name, hash_filter, spool, table

#: Tokens an item must have for a match to cost a document its place; fewer are common phrases.
LEAST_ITEM_TOKENS = 5
#: Near duplicates of the corpus: five-word shingles, four fifths.
WORDS, NUMERATOR, DENOMINATOR = 5, 4, 5


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the quality discriminant rejects."""
    held_out = F.coalesce(crc_mod(F.col("doc_id"), 5) == 0, F.lit(False))
    model = op4_discriminant.fit(docs.filter(~held_out), table(spark, sf_dir, "labels"))
    return docs.filter(op4_discriminant.quality_score(F.col("text"), model) >= op4_discriminant.THRESHOLD)


def told_apart(docs: DataFrame, key: Column, named: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """Rows whose key is surely not in the column ``name`` of ``named``, and rows to look at.

    Told by a bit filter of fixed size, so only the second part need be joined: the texts that stay are not
    shuffled, however many go. Rows without a key belong to the first part.
    """
    sent = docs.sparkSession.sparkContext.broadcast(hash_filter(named, name, named.count()))

    @F.pandas_udf("boolean")
    def maybe(keys: pd.Series) -> pd.Series:
        return pd.Series(sent.value.holds(keys.to_numpy(dtype="int64").view("uint64")))

    key = key.cast("long")
    doubtful = key.isNotNull() & maybe(F.coalesce(key, F.lit(0).cast("long")))
    return docs.filter(~doubtful), docs.filter(doubtful)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of every group of near duplicates; of repeated rows, one."""
    found = spool(op10_signature_trees.near_duplicates(docs, WORDS, NUMERATOR, DENOMINATOR), "classes")
    key = free_name(docs, "text_key")
    pair = ["doc_id", key]
    named = found.filter(F.col("doc_id").isNotNull())
    decided = spool(
        named.groupBy("doc_id", F.col("text_key").alias(key))
        .agg(F.count(F.lit(1)).alias("n"), F.bool_or(F.col("doc_id") != F.col("component_id")).alias("goes"))
        .filter("goes OR n > 1"),
        "decided",
    )
    keyed = docs.withColumn(key, F.xxhash64("text"))
    kept, doubtful = told_apart(keyed, F.when(F.col("doc_id").isNotNull(), F.col(key)), decided, key)
    gone = decided.filter("goes").select(pair)
    looked_at = doubtful.join(gone, pair, "left_anti").dropDuplicates(pair)
    return kept.unionByName(looked_at).select(docs.columns)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item of LEAST_ITEM_TOKENS tokens or more, or a variant of one."""
    leaks = op8_templates.contaminated(docs, table(spark, sf_dir, "benchmark")).filter(F.col("item_tokens") >= LEAST_ITEM_TOKENS)
    gone = spool(leaks.select("doc_id").distinct(), "leaks")
    kept, doubtful = told_apart(docs, F.col("doc_id"), gone, "doc_id")
    return kept.unionByName(doubtful.join(gone, "doc_id", "left_anti").select(docs.columns))


def replace_private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by surrogates; n_chars follows the new text."""
    made = op3_surrogates.with_surrogates(docs, kinds=free_name(docs, "surrogate_kinds"))
    if "n_chars" in docs.columns:
        made = made.withColumn("n_chars", F.length("text").cast("long"))
    return made.select(docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, as unsigned 32-bit little-endian bytes, with digests of ids and round trip."""
    return op9_merge_replay.encode_documents(docs, keep_ids=True)


STAGES = [
    ("quality classifier", keep_good),
    ("n-gram jaccard join", keep_one_of_each),
    ("benchmark decontamination", drop_leaks),
    ("pii surrogates", replace_private),
    ("byte-level bpe", encode),
]

#: The classifier, the merges and the surrogates are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = spool(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
