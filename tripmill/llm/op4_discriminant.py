"""Document quality by a regularised quadratic discriminant.

A document becomes a short vector of transformed statistics (square roots of the shares of byte classes and of words
that repeat the one before, logarithms of lengths). Per class, counts, sums and sums of products over all labelled
training rows are added up in Spark; a few hundred numbers reach the driver. Each class covariance is shrunk towards
the pooled one and towards a multiple of the identity, and its Cholesky factor is kept in the model. A score is the
posterior of label 1: the difference of the two Gaussian log-densities (Mahalanobis distance through the factor,
log-determinant from its diagonal) plus the log-ratio of the classes.

Defined cases: a null text is scored as an empty one; a document without words gets the statistics of zeros; labels that
are null or not 0/1 and rows without an id train nothing; a document labelled twice counts twice; with no or only one
class of labels the score is that class's share (0.5 without labels); an empty table gives no rows; other columns
are kept by ``with_quality`` and not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.llm.common import blocks, crc_mod, pieces, prepare_workers, table, word_hashes

#: Weight of the pooled covariance, and of the identity scaled to its mean variance.
TO_POOLED = 0.02
TO_IDENTITY = 0.002
#: Bytes and words added to the totals that shares are taken of, so that short texts have no extreme shares.
EXTRA_BYTES = 100
EXTRA_WORDS = 10
THRESHOLD = 0.3
BLOCK = 1 << 20

CLASSES = ("lower", "upper", "digit", "blank", "line", "bang", "stop", "bar", "symbol", "beyond")
_CLASS = np.full(256, CLASSES.index("symbol"), dtype=np.int64)
_CLASS[97:123] = CLASSES.index("lower")
_CLASS[65:91] = CLASSES.index("upper")
_CLASS[48:58] = CLASSES.index("digit")
_CLASS[[32, 9]] = CLASSES.index("blank")
_CLASS[[10, 11, 12, 13]] = CLASSES.index("line")
_CLASS[ord("!")] = CLASSES.index("bang")
_CLASS[[ord(c) for c in ".,;:?'\"()-"]] = CLASSES.index("stop")
_CLASS[ord("|")] = CLASSES.index("bar")
_CLASS[128:] = CLASSES.index("beyond")
SIZE = len(CLASSES) + 3


def statistics(texts: list[str | None]) -> np.ndarray:
    """One row of transformed statistics per text."""
    out = np.zeros((len(texts), SIZE))
    for first, run in blocks(texts, BLOCK):
        lengths = np.array([len(d) + 1 for d in run])  # each text is followed by a blank
        ends = np.cumsum(lengths)
        data = np.frombuffer(b" ".join(run) + b" ", dtype=np.uint8)
        counts = np.zeros(len(run) * len(CLASSES))
        for a, b in pieces(data):
            text = np.searchsorted(ends, np.arange(a, b), side="right")
            counts += np.bincount(text * len(CLASSES) + _CLASS[data[a:b]], minlength=len(counts))
        counts = counts.reshape(len(run), len(CLASSES))
        counts[:, CLASSES.index("blank")] -= 1
        hashes, begins = word_hashes(data)
        text = np.searchsorted(ends, begins, side="right")
        words = np.bincount(text, minlength=len(run))
        again = np.concatenate(([False], (hashes[1:] == hashes[:-1]) & (text[1:] == text[:-1]))) if len(hashes) else []
        repeats = np.bincount(text[again], minlength=len(run)) if len(hashes) else np.zeros(len(run))
        size = counts.sum(axis=1)
        rows = out[first : first + len(run)]
        rows[:, : len(CLASSES)] = np.sqrt(counts / (size + EXTRA_BYTES)[:, None])
        rows[:, -3] = np.sqrt(repeats / (words + EXTRA_WORDS))
        rows[:, -2] = np.log1p(size / np.maximum(words, 1))
        rows[:, -1] = np.log1p(words) / 10
    return out


@dataclass(frozen=True)
class Discriminant:
    """Class means, cached Cholesky factors of the shrunk covariances, and log-weights; label 1 second."""

    means: np.ndarray
    factors: np.ndarray
    log_weights: np.ndarray
    single: float | None = None

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.single is not None:
            return np.full(len(x), self.single)
        logs = []
        for mean, factor, weight in zip(self.means, self.factors, self.log_weights):
            z = np.linalg.solve(factor, (x - mean).T)
            logs.append(weight - np.log(np.diag(factor)).sum() - 0.5 * (z * z).sum(axis=0))
        return 1.0 / (1.0 + np.exp(np.clip(logs[0] - logs[1], -700, 700)))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality") -> Discriminant:
    """Fits on every document of ``docs`` that ``labels`` marks 0 or 1; restrict ``docs`` to hold rows out."""
    spark = docs.sparkSession
    prepare_workers(spark)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = statistics(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(list(x))], names=["doc_id", "x"])

    marks = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1)).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("mark")
    )
    measured = (
        docs.filter(F.col("doc_id").isNotNull())
        .select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .mapInArrow(measure, "doc_id long, x array<double>")
    )

    def moments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = np.zeros((2, 1 + SIZE + SIZE * SIZE))
        for batch in batches:
            x, mark = np.array(batch["x"].tolist()).reshape(-1, SIZE), batch["mark"].to_numpy()
            for c in (0, 1):
                own = x[mark == c]
                sums[c] += np.concatenate(([len(own)], own.sum(axis=0), (own.T @ own).ravel()))
        places = np.tile(np.arange(sums.shape[1]), 2)
        yield pd.DataFrame({"mark": np.repeat([0, 1], sums.shape[1]), "place": places, "value": sums.ravel()})

    added = (
        measured.join(marks, "doc_id")
        .mapInPandas(moments, "mark int, place int, value double")
        .groupBy("mark", "place")
        .agg(F.sum("value").alias("value"))
    )
    sums = np.zeros((2, 1 + SIZE + SIZE * SIZE))
    for row in added.collect():  # 2 x (1 + p + p * p) numbers
        sums[row["mark"], row["place"]] = row["value"]
    return _model(sums)


def _model(sums: np.ndarray) -> Discriminant:
    n = sums[:, 0]
    if n.min() == 0:
        empty = np.zeros((2, SIZE))
        return Discriminant(empty, empty, n, float(n[1] / n.sum()) if n.sum() else 0.5)
    means = sums[:, 1 : 1 + SIZE] / n[:, None]
    scatter = sums[:, 1 + SIZE :].reshape(2, SIZE, SIZE) - n[:, None, None] * np.einsum("ci,cj->cij", means, means)
    pooled = scatter.sum(axis=0) / max(n.sum() - 2, 1)
    factors = []
    for c in (0, 1):
        own = scatter[c] / max(n[c] - 1, 1)
        shrunk = (1 - TO_POOLED) * own + TO_POOLED * pooled
        level = max(np.trace(shrunk) / SIZE, 1e-9)
        shrunk = (1 - TO_IDENTITY) * shrunk + TO_IDENTITY * level * np.eye(SIZE)
        factors.append(np.linalg.cholesky((shrunk + shrunk.T) / 2))
    return Discriminant(means, np.array(factors), np.log(n / n.sum()))


def quality_score(text: Column, model: Discriminant) -> Column:
    """The posterior of label 1 as a column: no shuffle, whatever columns go along."""

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(model.scores(statistics(texts.tolist())))

    return score(text)


def query(spark, sf_dir: str) -> DataFrame:
    """op4: quality of all documents, learnt from the labels of those that are not held out."""
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(crc_mod(F.col("doc_id"), 5) == 0, F.lit(False))
    model = fit(docs.filter(~held_out), table(spark, sf_dir, "labels"))
    scored = docs.select("doc_id", held_out.alias("held_out"), quality_score(F.col("text"), model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
