"""Language identification by prediction by partial matching (PPM, escape method C) over bytes.

Per language, a context tree holds how often each byte followed each context of 0 to ORDER bytes. The code length of a
byte starts at its longest known context; where the byte is new there, the escape probability is paid and the next
shorter context is asked, without the bytes already excluded; at the end stands a uniform code over the
remaining bytes. Statistics are frozen after training, so the code length of a byte depends only on the ORDER bytes
before it: a block of texts is scored once per distinct (context, byte) and language, and summed per text. The
code lengths of all 256 bytes after any context add up to one exactly (as probabilities).

Training counts are added up in Spark over a bounded sample of labelled documents (``PER_LANGUAGE`` documents of at most
``LONGEST`` bytes each, picked by a hash), so the trees have a size bound and may be sent to every task. Every
text is scored as a whole; the shortest code wins, ties go to the smaller name. ``score`` is the winner's
posterior under equal weights.

Defined cases: a null text and a text without letters are ``und`` with score 0; with no labelled document all are
``und``; documents without a language or an id train nothing; repeated rows count each; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.llm.common import blocks, bounded_sample, crc_mod, prepare_workers, table

#: Bytes of the longest context.
ORDER = 4
PER_LANGUAGE = 400
LONGEST = 1 << 15
BLOCK = 1 << 20
UNKNOWN = "und"

_LETTER = regex.compile(r"\p{L}")


def plain(text: str | None) -> str:
    """Case tells nothing about a language here, and shouting hides it."""
    return (text or "").lower()


def grams(run: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(context and byte as one number, text) for every byte; before a text stand ORDER zero bytes."""
    pad = b"\0" * ORDER
    data = np.frombuffer(b"".join(pad + d for d in run), dtype=np.uint8).astype(np.uint64)
    text = np.repeat(np.arange(len(run)), [len(d) + ORDER for d in run])
    keys = np.zeros(len(data), dtype=np.uint64)
    for back in range(ORDER + 1):
        shifted = np.concatenate((np.zeros(back, dtype=np.uint64), data[: len(data) - back]))
        keys |= shifted << np.uint64(8 * back)
    starts = np.cumsum([0] + [len(d) + ORDER for d in run])[:-1]
    place = np.arange(len(data)) - np.repeat(starts, [len(d) + ORDER for d in run])
    real = place >= ORDER
    return keys[real], text[real]


def gram_runs(run: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``grams`` of a run; a text alone is cut into blocks, each read with the ORDER bytes before it."""
    if len(run) > 1:
        yield grams(run)
        return
    data = run[0]
    for first in range(0, len(data), BLOCK):
        before = min(first, ORDER)
        keys, text = grams([data[first - before : first + BLOCK]])
        yield keys[before:], text[before:]


class Tree:
    """Frozen statistics of one language, by order: symbols after contexts, and totals of contexts."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        self.symbols, self.contexts = [], []
        for order in range(ORDER + 1):
            low = np.uint64((1 << 8 * (order + 1)) - 1)
            own, place = np.unique(keys & low, return_inverse=True)
            n = np.bincount(place, weights=counts, minlength=len(own))
            first = np.flatnonzero(np.concatenate(([True], own[1:] >> np.uint64(8) != own[:-1] >> np.uint64(8))))
            context = own[first] >> np.uint64(8)
            total = np.add.reduceat(n, first) if len(own) else np.zeros(0)
            kinds = np.diff(np.concatenate((first, [len(own)]))).astype(float)
            if order:
                # What the symbols of this context weigh one order lower: it is left out there after an escape.
                below, weight = self.symbols[order - 1]
                at = np.searchsorted(below, own & (low >> np.uint64(8)))
                shared = np.add.reduceat(weight[at], first) if len(own) else np.zeros(0)
            else:
                shared = np.zeros(len(first))
            self.symbols.append((own, n))
            self.contexts.append((context, total, kinds, shared))

    def code_lengths(self, keys: np.ndarray) -> np.ndarray:
        """Bits of each (context, byte)."""
        bits = np.zeros(len(keys))
        left_mass, left_kinds = np.zeros(len(keys)), np.zeros(len(keys))  # excluded by the longer context
        open_ = np.arange(len(keys))
        for order in range(ORDER, -1, -1):
            low = np.uint64((1 << 8 * (order + 1)) - 1)
            own, n = self.symbols[order]
            context, total, kinds, shared = self.contexts[order]
            if not len(context):
                continue
            key = keys[open_] & low
            at = np.minimum(np.searchsorted(context, key >> np.uint64(8)), len(context) - 1)
            known = context[at] == key >> np.uint64(8)
            here, at, key = open_[known], at[known], key[known]
            mass, fresh = total[at] - left_mass[here], kinds[at] - left_kinds[here]
            place = np.minimum(np.searchsorted(own, key), len(own) - 1)
            hit = own[place] == key
            whole = mass + fresh
            bits[here[hit]] += np.log2(whole[hit] / n[place[hit]])
            missed = here[~hit]
            bits[missed] += np.where(fresh[~hit] > 0, np.log2(np.maximum(whole[~hit], 1) / np.maximum(fresh[~hit], 1)), 0)
            left_mass[missed], left_kinds[missed] = shared[at[~hit]], kinds[at[~hit]]
            done = np.zeros(len(keys), dtype=bool)
            done[here[hit]] = True
            open_ = open_[~done[open_]]
        bits[open_] += np.log2(256 - left_kinds[open_])
        return bits


@dataclass(frozen=True)
class Languages:
    names: list[str]
    trees: list[Tree]

    def lengths(self, texts: list[str | None]) -> np.ndarray:
        """Bits of each whole text in each language."""
        out = np.zeros((len(texts), len(self.trees)))
        for first, run in blocks([plain(t) for t in texts], BLOCK):
            for keys, text in gram_runs(run):
                own, place = np.unique(keys, return_inverse=True)
                for language, tree in enumerate(self.trees):
                    bits = tree.code_lengths(own)[place]
                    out[first : first + len(run), language] += np.bincount(text, weights=bits, minlength=len(run))
        return out


def train(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Languages:
    """Counts over a bounded sample of the labelled documents of ``docs``."""
    prepare_workers(docs.sparkSession)
    usable = docs.filter(
        F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & (F.octet_length("text") <= LONGEST)
    ).select("doc_id", "lang", "text")
    sample = bounded_sample(usable, F.col("doc_id"), "lang", per_language)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lang, own in batch.groupby("lang"):
                for _, run in blocks([plain(t) for t in own["text"]], BLOCK):
                    keys, n = np.unique(grams(run)[0], return_counts=True)
                    yield pd.DataFrame({"lang": lang, "gram": keys.astype(np.int64), "n": n})

    counted = (
        sample.mapInPandas(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    )
    names, trees = [], []
    # Bounded: languages x per_language x LONGEST entries at the very most.
    for lang, own in counted.toPandas().groupby("lang"):
        names.append(lang)
        trees.append(Tree(own["gram"].to_numpy().astype(np.uint64), own["n"].to_numpy()))
    return Languages(names, trees)


def identify(docs: DataFrame, model: Languages) -> DataFrame:
    """(doc_id, lang_pred, score, bits_per_byte) for every row."""
    spark = docs.sparkSession
    prepare_workers(spark)
    sent = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, trees = sent.value.names, sent.value.trees
        for batch in batches:
            texts = batch.column("text").to_pylist()
            with_letters = np.array([bool(t and _LETTER.search(t)) for t in texts]) & bool(trees)
            if trees:
                lengths = sent.value.lengths(texts)
                best = lengths.argmin(axis=1)
                shortest = lengths[np.arange(len(texts)), best]
                score = 1 / np.exp2(np.maximum(shortest[:, None] - lengths, -1000)).sum(axis=1)
            else:
                best, shortest, score = (np.zeros(len(texts), dtype=int) for _ in range(3))
            size = np.array([len(plain(t).encode("utf-8")) for t in texts])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([names[b] if ok else UNKNOWN for b, ok in zip(best, with_letters)], pa.string()),
                    pa.array(np.where(with_letters, score, 0.0), pa.float64()),
                    pa.array(np.where(with_letters, shortest / np.maximum(size, 1), 0.0), pa.float64()),
                ],
                names=["doc_id", "lang_pred", "score", "bits_per_byte"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, lang_pred string, score double, bits_per_byte double"
    )


def query(spark, sf_dir: str) -> DataFrame:
    """op2: language of all documents, learnt from those that are not held out."""
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(crc_mod(F.col("doc_id"), 3) == 1, F.lit(False))
    model = train(docs.filter(~held_out))
    found = identify(docs, model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "bits_per_byte")
