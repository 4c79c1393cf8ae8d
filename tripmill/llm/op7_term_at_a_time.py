"""Exact top-k inner products by exhaustive term-at-a-time accumulation.

Vectors are turned into integers; each dimension is a term, and the non-zero components of a query are its terms. The
candidates of a cell are kept as postings per dimension (places and weights); each query term scatters its weighted
postings into the query's dense array of scores. A partition selection then leaves k per query and cell, and a window
over these few rows merges the cells.

Queries and candidates are dealt into groups of a fixed number of rows, and every pair of groups is a cell of its
own. Neither side is broadcast or collected: a task holds one group of each and a tile of scores. Work is queries x
candidates x dimensions by definition of an exhaustive search.

Defined cases: vectors that are null, or hold null or non-finite components, and rows without an id take no part; identical
rows count once; several different vectors under one id give that id's best score; vectors of different lengths share
their common dimensions; ties go to the smaller id; a query with fewer than k other ids returns all; an empty table
gives no rows. Products are added up in 64 bits where a cell's largest components prove that they fit, and in whole
numbers of any size elsewhere; a returned score beyond a long ends the query with an error that names both ids.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from tripmill.llm.common import prepare_workers, table

TOP = 5
SCALE = 256
#: Rows of a candidate group and of a query group.
CANDIDATE_ROWS = 8192
QUERY_ROWS = 4096
#: Scores kept at a time: queries x candidates of one tile.
TILE_QUERIES = 32
LONG = 1 << 63


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, v): distinct usable rows with their components as they are (floats) or as doubles."""
    x = F.transform("embedding", lambda c: c.cast("double"))
    fine = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))))
    kind = vectors.schema["embedding"].dataType
    kept = F.col("embedding") if kind == ArrayType(FloatType(), kind.containsNull) else x
    return (
        vectors.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & F.coalesce(fine, F.lit(False)))
        .select(F.col("vec_id").cast("long").alias("vec_id"), kept.alias("v"))
        .distinct()
    )


def quantised(rows: pd.Series, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x) of all components, a row each: 64-bit integers, or Python's where a double holds no fraction."""
    width = max((len(r) for r in rows), default=0)
    values = np.zeros((len(rows), width))
    for i, r in enumerate(rows):
        values[i, : len(r)] = r
    if (np.abs(values) < 2.0**53 / scale).all():
        return np.floor(values * scale).astype(np.int64)
    exact = [[math.floor(x * scale) if abs(x) < 2.0**53 / scale else int(x) * scale for x in row] for row in values.tolist()]
    return np.array(exact, dtype=object).reshape(values.shape)


def in_64_bits(queries: np.ndarray, candidates: np.ndarray) -> bool:
    """Whether no sum of products of a query and a candidate can leave 64 bits."""
    if queries.dtype == object or candidates.dtype == object:
        return False
    most = (np.abs(m).max(axis=0, initial=0).tolist() for m in (queries, candidates))
    return sum(a * b for a, b in zip(*most)) < LONG


def _chosen(row: np.ndarray, ids: np.ndarray, other: np.ndarray, k: int) -> list[int]:
    """Places of the k best others, of scores of any size; every id once."""
    kept, seen = [], set()
    for i in sorted(other.tolist(), key=lambda i: (-row[i], ids[i])):
        if ids[i] not in seen:
            seen.add(ids[i])
            kept.append(i)
    return kept[:k]


def best(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, candidates: np.ndarray, k: int):
    """(query id, id, score, beyond) of the k best other ids of each query within one cell; every id once.

    A score that a long cannot hold is given as the nearest one and marked as beyond.
    """
    if not in_64_bits(queries, candidates):
        queries, candidates = queries.astype(object), candidates.astype(object)
    places = [np.flatnonzero(candidates[:, d]) for d in range(candidates.shape[1])]
    weights = [candidates[p, d] for d, p in enumerate(places)]
    repeated = len(np.unique(ids)) < len(ids)
    found = []
    for first in range(0, len(queries), TILE_QUERIES):
        tile = queries[first : first + TILE_QUERIES]
        scores = np.zeros((len(tile), len(ids)), dtype=candidates.dtype)
        for d in range(min(tile.shape[1], len(places))):
            terms = np.flatnonzero(tile[:, d])  # rows of the tile that have this term
            if not len(terms) or not len(places[d]):
                continue
            add = tile[terms, d][:, None] * weights[d][None, :]
            if len(terms) == len(tile) and len(places[d]) == len(ids):
                scores += add
            else:
                scores[np.ix_(terms, places[d])] += add
        for row, own in zip(scores, query_ids[first : first + TILE_QUERIES].tolist()):
            other = np.flatnonzero(ids != own)
            if row.dtype == object:
                for i in _chosen(row, ids, other, k):
                    score = min(max(row[i], -LONG), LONG - 1)
                    found.append((own, int(ids[i]), score, score != row[i]))
                continue
            if repeated:  # one entry for each id, with its best score
                by = other[np.lexsort((-row[other], ids[other]))]
                other = by[np.concatenate(([True], ids[by[1:]] != ids[by[:-1]]))] if len(by) else by
            if len(other) > k:
                edge = np.partition(row[other], len(other) - k)[len(other) - k]
                other = other[row[other] >= edge]  # with all ties at the edge
                other = other[np.lexsort((ids[other], -row[other]))][:k]
            found += [(own, int(ids[i]), int(row[i]), False) for i in other]
    return found


def search(vectors: DataFrame, every: int = 50, k: int = TOP) -> DataFrame:
    """(query_id, rank, vec_id, score) for the rows whose id is divisible by ``every``."""
    prepare_workers(vectors.sparkSession)
    rows = usable(vectors)
    n = vectors.count()
    groups, query_groups = max(1, -(-n // CANDIDATE_ROWS)), max(1, -(-n // (every * QUERY_ROWS)))
    place = F.xxhash64("vec_id", "v")
    # Columns of their own names: both sides of a cogroup may otherwise be taken for the same columns.
    named = (F.col("vec_id").alias("other_id"), F.col("v").alias("weights"))
    candidates = rows.select(*named, F.pmod(place, F.lit(groups)).alias("g")).withColumn(
        "h", F.explode(F.sequence(F.lit(0), F.lit(query_groups - 1)).cast("array<long>"))
    )
    queries = (
        rows.filter(F.col("vec_id") % every == 0)
        .select("vec_id", "v", F.pmod(place, F.lit(query_groups)).alias("h"))
        .withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)).cast("array<long>")))
    )

    def cell(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(left) and len(right):
            found = best(left["vec_id"].to_numpy(), quantised(left["v"]), right["other_id"].to_numpy(), quantised(right["weights"]), k)
        out = pd.DataFrame(found, columns=["query_id", "vec_id", "score", "beyond"])
        return out.astype({"query_id": "int64", "vec_id": "int64", "score": "int64", "beyond": "bool"})

    partial = (
        queries.groupBy("g", "h")
        .cogroup(candidates.groupBy("g", "h"))
        .applyInPandas(cell, "query_id long, vec_id long, score long, beyond boolean")
    )
    merged = partial.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"), F.bool_or("beyond").alias("beyond"))
    ranked = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    kept = merged.withColumn("rank", ranked.cast("int")).filter(F.col("rank") <= k)
    fault = F.concat(F.lit("the score of vectors "), "query_id", F.lit(" and "), "vec_id", F.lit(" does not fit a long"))
    score = F.when(F.col("beyond"), F.raise_error(fault).cast("long")).otherwise(F.col("score"))
    return kept.select("query_id", "rank", "vec_id", score.alias("score"))


def query(spark, sf_dir: str) -> DataFrame:
    """op7: five best other vectors for every fiftieth."""
    return search(table(spark, sf_dir, "embeddings"))


SQL = """
WITH usable AS (
    SELECT DISTINCT vec_id, [floor(256 * x::DOUBLE)::BIGINT FOR x IN embedding] AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len([x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0
),
scored AS (
    SELECT q.vec_id AS query_id, c.vec_id AS vec_id, max(list_inner_product(q.v::DOUBLE[], c.v::DOUBLE[]))::BIGINT AS score
    FROM usable q JOIN usable c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
    GROUP BY 1, 2
)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
FROM scored
QUALIFY rank <= 5
"""
