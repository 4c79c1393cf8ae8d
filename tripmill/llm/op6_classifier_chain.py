"""Toxicity by a classifier chain.

Categories are predicted one after another; each linear (logistic) model sees the document's words and the
probabilities of the categories before it. In training those are out-of-fold: a row's earlier probabilities come from
models that did not see the row, as at prediction time. The last link is ``toxic`` itself, as ``labels`` marks it; the
categories before it are weakly labelled: a toxic document that holds one of a category's seed words.

Words are chosen by data: all that at least LEAST_DOCS toxic training documents hold and that speak for the label with
a chi-square of SIGNIFICANT, however many they are. Training uses a bounded sample of labelled rows (``PER_LABEL`` of each
label); word counts are added up in Spark, and what reaches the driver is the chosen words and the sample's rows over
them, as places of what is not zero. Every document is scored over its whole text without a shuffle.

Defined cases: a null or empty text has no words and gets the chain's prior; labels that are null or not 0/1 and
rows without an id train nothing; without labels of both kinds every probability is the share of toxic rows (0 without
labels); repeated rows give repeated results; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.llm.common import bounded_sample, prepare_workers, table

#: Weak categories in chain order; words are seeds for labels, not rules for results.
CATEGORIES: dict[str, tuple[str, ...]] = {
    "insult": ("idiot", "moron", "loser", "clown", "fool", "imbecile", "jerk"),
    "contempt": ("stupid", "pathetic", "worthless", "useless", "dumb", "ridiculous"),
    "degrading": ("scum", "trash", "vermin", "garbage", "filth", "parasite"),
    "disgust": ("disgusting", "vile", "revolting", "repulsive", "nasty"),
}
LAST = "toxic"
PER_LABEL = 6000
LEAST_DOCS = 3
#: Chi-square with one degree of freedom, one-sided, at 5 %.
SIGNIFICANT = 2.706
FOLDS = 5
PENALTY = 0.02
STEPS = 25
#: Rounds of conjugate gradients in one Newton step.
ROUNDS = 200
#: Lengths of word beginnings that count as words of their own.
STEMS = (4, 5)

_WORD = regex.compile(r"\p{L}[\p{L}\p{M}']*")


def words(text: str | None) -> set[str]:
    """Distinct words in lower case, and the beginnings of longer ones, which inflected forms share."""
    own = set(_WORD.findall((text or "").lower()))
    return own | {f"{w[:n]}*" for n in STEMS for w in own if len(w) > n}


@dataclass(frozen=True)
class Rows:
    """A table by the places and values of what is not zero."""

    row: np.ndarray
    column: np.ndarray
    value: np.ndarray
    shape: tuple[int, int]

    @staticmethod
    def of(x: np.ndarray | Rows) -> Rows:
        if isinstance(x, Rows):
            return x
        row, column = np.nonzero(x)
        return Rows(row, column, x[row, column].astype(float), x.shape)

    @staticmethod
    def at(places: list[list[int]], columns: int) -> Rows:
        """Ones at the places of each row."""
        row = np.repeat(np.arange(len(places)), [len(p) for p in places])
        column = np.array([c for p in places for c in p], dtype=np.int64)
        return Rows(row, column, np.ones(len(column)), (len(places), columns))

    def times(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, self.value * w[self.column], minlength=self.shape[0])

    def sums(self, r: np.ndarray) -> np.ndarray:
        """Per column, the values weighted by row."""
        return np.bincount(self.column, self.value * r[self.row], minlength=self.shape[1])

    def beside(self, other: Rows) -> Rows:
        return Rows(
            np.concatenate([self.row, other.row]),
            np.concatenate([self.column, other.column + self.shape[1]]),
            np.concatenate([self.value, other.value]),
            (self.shape[0], self.shape[1] + other.shape[1]),
        )

    def only(self, own: np.ndarray) -> Rows:
        held, place = own[self.row], np.cumsum(own) - 1
        return Rows(place[self.row[held]], self.column[held], self.value[held], (int(own.sum()), self.shape[1]))


@dataclass(frozen=True)
class Chain:
    """Weights per link over [1, words, earlier links]."""

    names: list[str]
    vocabulary: dict[str, int]
    weights: list[np.ndarray]
    share: float = 0.0

    def probabilities(self, present: np.ndarray | Rows) -> np.ndarray:
        if not self.weights:
            return np.full((present.shape[0], len(self.names)), self.share)
        x = Rows.of(np.ones((present.shape[0], 1))).beside(Rows.of(present))
        out = []
        for w in self.weights:
            p = _sigmoid(x.times(w))
            out.append(p)
            x = x.beside(Rows.of(p[:, None]))
        return np.column_stack(out)

    def places(self, text: str | None) -> list[int]:
        return sorted(self.vocabulary[w] for w in words(text) if w in self.vocabulary)

    def presence(self, texts: list[str | None]) -> Rows:
        return Rows.at([self.places(text) for text in texts], len(self.vocabulary))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -60, 60)))


def _solve(bend, diagonal: np.ndarray, slope: np.ndarray) -> np.ndarray:
    """``bend(step) = slope`` by conjugate gradients, as exactly as the slope is small."""
    step, rest = np.zeros(len(slope)), slope.copy()
    ahead = rest / diagonal
    way, size = ahead.copy(), rest @ ahead
    enough = size * min(0.01, np.sqrt(size))
    for _ in range(ROUNDS):
        if size <= enough:
            break
        bent = bend(way)
        pace = size / (way @ bent)
        step += pace * way
        rest -= pace * bent
        ahead = rest / diagonal
        size, before = rest @ ahead, size
        way = ahead + size / before * way
    return step


def logistic(x: np.ndarray | Rows, y: np.ndarray) -> np.ndarray:
    """Ridge-penalised logistic regression by Newton steps, which are halved while they lead uphill."""
    x = Rows.of(x)
    squares = Rows(x.row, x.column, x.value**2, x.shape)
    penalty = np.full(x.shape[1], PENALTY)
    penalty[0] = 1e-3

    def loss(w: np.ndarray, z: np.ndarray) -> float:
        return (np.logaddexp(0, z) - y * z).sum() + (penalty * w * w).sum() / 2

    w = np.zeros(x.shape[1])
    z = x.times(w)
    for _ in range(STEPS):
        p = _sigmoid(z)
        slope = x.sums(p - y) + penalty * w
        if np.abs(slope).max() < 1e-6:
            break
        n = p * (1 - p)
        step = _solve(lambda v, n=n: x.sums(n * x.times(v)) + penalty * v, squares.sums(n) + penalty, slope)
        now, along = loss(w, z), x.times(step)
        while loss(w - step, z - along) > now and np.abs(step).max() > 1e-9:
            step, along = step / 2, along / 2
        w, z = w - step, z - along
        if np.abs(step).max() < 1e-6:
            break
    return w


def fit_chain(present: np.ndarray | Rows, marks: np.ndarray, folds: np.ndarray) -> list[np.ndarray]:
    """One model per column of ``marks``; earlier probabilities enter out of fold."""
    x = Rows.of(np.ones((present.shape[0], 1))).beside(Rows.of(present))
    weights = []
    for y in marks.T:
        weights.append(logistic(x, y))
        if len(weights) == marks.shape[1]:
            break  # no later link reads this one's probabilities
        ahead = np.zeros(len(y))
        for fold in range(FOLDS):
            own = folds == fold
            if own.any() and not own.all():
                ahead[own] = _sigmoid(x.only(own).times(logistic(x.only(~own), y[~own])))
            elif own.any():
                ahead[own] = _sigmoid(x.only(own).times(weights[-1]))
        x = x.beside(Rows.of(np.round(ahead, 3)[:, None]))
    return weights


def train(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL) -> Chain:
    spark = docs.sparkSession
    prepare_workers(spark)
    names = [*CATEGORIES, LAST]
    marks = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1)).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("mark")
    )
    sizes = {r["mark"]: r["n"] for r in marks.groupBy("mark").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(sizes) < 2:
        return Chain(names, {}, [], 1.0 if 1 in sizes else 0.0)
    chosen = bounded_sample(marks, F.col("doc_id"), "mark", per_label).distinct()
    # The sample has a size bound (two labels, per_label rows each), so it may go to every task.
    sample = (
        docs.filter(F.col("doc_id").isNotNull())
        .select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .join(F.broadcast(chosen), "doc_id")
    )

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen, toxic = Counter(), Counter()
        for batch in batches:
            for text, mark in zip(batch["text"], batch["mark"]):
                own = words(text)
                seen.update(own)
                if mark:
                    toxic.update(own)
        if seen:
            yield pd.DataFrame({"word": list(seen), "n": list(seen.values()), "n_toxic": [toxic[w] for w in seen]})

    by_label = sample.groupBy("mark").agg(F.count(F.lit(1)).alias("n")).collect()
    docs_of = {r["mark"]: float(r["n"]) for r in by_label}
    if len(docs_of) < 2:
        return Chain(names, {}, [], 1.0 if 1 in docs_of else 0.0)
    n0, n1 = docs_of[0], docs_of[1]
    a, c = F.col("n_toxic"), F.col("n") - F.col("n_toxic")
    chi = (
        (n0 + n1)
        * F.pow(a * (n0 - c) - c * (n1 - a), F.lit(2.0))
        / (n1 * n0 * F.col("n") * F.greatest(F.lit(n0 + n1) - F.col("n"), F.lit(1.0)))
    )
    counted = (
        sample.mapInPandas(count, "word string, n long, n_toxic long")
        .groupBy("word")
        .agg(F.sum("n").cast("double").alias("n"), F.sum("n_toxic").cast("double").alias("n_toxic"))
        .filter((F.col("n_toxic") >= LEAST_DOCS) & (F.col("n_toxic") * n0 > c * n1) & (chi >= SIGNIFICANT))
    )
    seeds = {w for ws in CATEGORIES.values() for w in ws}
    vocabulary = {w: i for i, w in enumerate(sorted({r["word"] for r in counted.select("word").collect()} | seeds))}
    frozen = Chain(names, vocabulary, [])

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            places = [frozen.places(text) for text in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "mark": batch["mark"], "places": places})

    # Bounded: the sample's rows over the words chosen from it.
    got = sample.mapInPandas(rows, "doc_id long, mark int, places array<int>").toPandas()
    present = Rows.at(got["places"].tolist(), len(vocabulary))
    toxic = got["mark"].to_numpy().astype(float)
    weak = [toxic * (present.times(np.isin(np.arange(len(vocabulary)), [vocabulary[w] for w in ws])) > 0) for ws in CATEGORIES.values()]
    folds = (got["doc_id"].to_numpy() * 2654435761 >> 7) % FOLDS
    weights = fit_chain(present, np.column_stack([*weak, toxic]), folds)
    # The sample evens out the labels; the last link gets the true odds back. Those before it keep the sample's odds:
    # the links after them were trained on such probabilities.
    weights[-1][0] += np.log((sizes[1] / sizes[0]) / (n1 / n0))
    return Chain(names, vocabulary, weights)


def score(docs: DataFrame, chain: Chain, threshold: float = 0.5) -> DataFrame:
    """(doc_id, one probability per link, predicted) for every row."""
    prepare_workers(docs.sparkSession)
    names = [f"p_{n}" for n in chain.names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = chain.probabilities(chain.presence(batch.column("text").to_pylist()))
            columns = [batch.column("doc_id"), *(pa.array(c) for c in p.T.astype(float))]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array((p[:, -1] >= threshold).astype(np.int32))], names=["doc_id", *names, "predicted"]
            )

    schema = "doc_id long, " + ", ".join(f"{n} double" for n in names) + ", predicted int"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


def query(spark, sf_dir: str) -> DataFrame:
    """op6: toxicity of all documents."""
    docs = table(spark, sf_dir, "documents")
    return score(docs, train(docs, table(spark, sf_dir, "labels")))
