"""Exact histogram of encoded document lengths, and suffix sums over it.

Every task encodes its own documents and hands on one row per distinct length, so the shuffle carries lengths and
never texts. From the histogram, suffix sums answer for every context limit L: how many documents fit, how many
tokens there are, how many remain when each document is cut at L, and which quantile L is. The sums are taken
in two levels (within a bucket of lengths, then over bucket totals), so no task holds all lengths in one window.

Defined cases: null and empty texts have length 0 and count as documents; repeated rows count each; an empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmill.llm import bpe_files
from tripmill.llm.common import prepare_workers, spool, table

#: Lengths of one bucket of the two-level sums: 2 to this power.
BUCKET_BITS = 10


def length_histogram(docs: DataFrame, path: str | None = None, text: str = "text") -> DataFrame:
    """(n_tokens, n_docs): how many documents encode to each length."""
    path = path or bpe_files.default_path()

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode, seen = bpe_files.encoding(path).encode_ordinary, Counter()
        for batch in batches:
            seen.update(len(encode(x)) if x else 0 for x in batch["text"])
        if seen:
            yield pd.DataFrame({"n_tokens": list(seen), "n_docs": list(seen.values())})

    prepare_workers(docs.sparkSession)
    partial = docs.select(F.col(text).alias("text")).mapInPandas(count, "n_tokens long, n_docs long")
    return partial.groupBy("n_tokens").agg(F.sum("n_docs").alias("n_docs"))


def suffix_sums(histogram: DataFrame) -> DataFrame:
    """One row per distinct length, taken as the context limit.

    docs_within / docs_over: documents of at most / more than the limit; tokens_within / tokens_over: their tokens;
    tokens_truncated: all tokens that remain when every document is cut at the limit; quantile: docs_within over all.
    """
    rows = histogram.withColumns(
        {
            "bucket": F.shiftright("n_tokens", BUCKET_BITS),
            "tokens": F.col("n_tokens") * F.col("n_docs"),
        }
    )
    per_bucket = rows.groupBy("bucket").agg(F.sum("n_docs").alias("b_docs"), F.sum("tokens").alias("b_tokens"))
    longer = Window.orderBy(F.col("bucket").desc()).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    offsets = per_bucket.select(
        "bucket",
        F.coalesce(F.sum("b_docs").over(longer), F.lit(0)).alias("above_docs"),
        F.coalesce(F.sum("b_tokens").over(longer), F.lit(0)).alias("above_tokens"),
        F.sum("b_docs").over(every).alias("all_docs"),
        F.sum("b_tokens").over(every).alias("all_tokens"),
    )
    inside = Window.partitionBy("bucket").orderBy(F.col("n_tokens").desc()).rowsBetween(Window.unboundedPreceding, -1)
    over_docs = F.coalesce(F.sum("n_docs").over(inside), F.lit(0)) + F.col("above_docs")
    over_tokens = F.coalesce(F.sum("tokens").over(inside), F.lit(0)) + F.col("above_tokens")
    return (
        rows.join(offsets, "bucket")
        .withColumns({"docs_over": over_docs, "tokens_over": over_tokens})
        .select(
            "n_tokens",
            "n_docs",
            (F.col("all_docs") - F.col("docs_over")).alias("docs_within"),
            "docs_over",
            (F.col("all_tokens") - F.col("tokens_over")).alias("tokens_within"),
            "tokens_over",
            (F.col("all_tokens") - F.col("tokens_over") + F.col("n_tokens") * F.col("docs_over")).alias(
                "tokens_truncated"
            ),
            ((F.col("all_docs") - F.col("docs_over")) / F.col("all_docs")).alias("quantile"),
        )
    )


def totals_at(histogram: DataFrame, limits: Sequence[int]) -> DataFrame:
    """The same totals for any limits, also such that no document has as its length."""
    n, length = F.col("n_docs"), F.col("n_tokens")
    found = [
        F.struct(
            F.lit(int(limit)).cast("long").alias("context_limit"),
            F.sum(F.when(length <= limit, n).otherwise(0)).alias("docs_within"),
            F.sum(F.least(length, F.lit(int(limit))) * n).alias("tokens_truncated"),
        )
        for limit in limits
    ]
    return histogram.agg(F.array(*found).alias("found")).select(F.explode("found").alias("f")).select("f.*")


def quantiles(sums: DataFrame, shares: Sequence[float]) -> DataFrame:
    """Smallest length within which at least the given share of documents lies."""
    found = [
        F.struct(F.lit(float(q)).alias("share"), F.min(F.when(F.col("quantile") >= q, F.col("n_tokens"))).alias("length"))
        for q in shares
    ]
    return sums.agg(F.array(*found).alias("found")).select(F.explode("found").alias("f")).select("f.*")


def query(spark, sf_dir: str) -> DataFrame:
    """op1: suffix sums over the lengths of all documents."""
    return suffix_sums(spool(length_histogram(table(spark, sf_dir, "documents")), "lengths"))
