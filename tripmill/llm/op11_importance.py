"""Importance resampling towards a target text distribution, with Arrow kernels.

Texts are lowered and split by Arrow's ``ascii_lower`` and ``split_pattern_regex``, flattened and dictionary-encoded. Runs
of two words are pairs of dictionary indices, the second shifted by one place; each distinct pair gets its CRC from the
CRCs of its two words (the checksum of a joined text is linear in that of its parts), and ``take`` deals the buckets to
the occurrences. One pass adds up bucket counts of the corpus, the next reduces the buckets' gains per document.

Only 10,000 counts of either side reach the driver. The draw needs no global sort: scores are whole numbers in a range
that the doubles bound (``SCORE_BOUND``), so their histogram is small at any size; it tells the score at which the draw
ends and how many come before each score, and only documents drawn are numbered, each score for itself.

Texts longer than PIECE_BYTES are cut between words; the last word of a piece leads the next one, so no pair is lost.

Defined cases: null and wordless texts have no features, weight 0 and are not drawn; a null id is hashed as an empty one
and comes last among ties; repeated rows count and are drawn each for itself; ties go to the smaller id; empty tables
give no rows, or gains from the other side alone; extra columns of any name are not read.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmill.llm.common import prepare_workers, spool, table

BUCKETS = 10_000
SEED = 7
LEAST_WORDS = 20
PERCENT = 25
#: Text bytes worked on at a time; longer texts are cut.
PIECE_BYTES = 4 << 20
#: No score is beyond: 1000 * ln of a quotient of products of 64-bit counts, and of the noise's range.
SCORE_BOUND = 120_000

# What lies between words, and the reversed polynomial of CRC-32.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_POLYNOMIAL = 0xEDB88320
_BETWEEN = re.compile(SEPARATORS)


@lru_cache(maxsize=256)
def _append_table(length: int) -> np.ndarray:
    """For each byte of a CRC, what it becomes after ``length`` zero bytes (4 x 256)."""
    state = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        state = np.where(state & 1, (state >> 1) ^ np.uint32(_POLYNOMIAL), state >> 1)
    basis = np.uint32(1) << np.arange(32, dtype=np.uint32)
    for _ in range(length):
        basis = state[basis & 0xFF] ^ (basis >> np.uint32(8))
    out = np.zeros((4, 256), dtype=np.uint32)
    values = np.arange(256)
    for place in range(4):
        for bit in range(8):
            out[place] ^= np.where(values >> bit & 1, basis[8 * place + bit], np.uint32(0)).astype(np.uint32)
    return out


def joined_crc(first: np.ndarray, second: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CRC-32 of a followed by b, from both CRCs and the bytes of b."""
    out = second.copy()
    for length in np.unique(lengths).tolist():
        at = np.flatnonzero(lengths == length)
        tables, crc = _append_table(length), first[at]
        out[at] ^= tables[0][crc & 0xFF] ^ tables[1][crc >> 8 & 0xFF] ^ tables[2][crc >> 16 & 0xFF] ^ tables[3][crc >> 24]
    return out


def text_pieces(texts: pa.Array) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """(texts, places of their documents, whether led by the last word of the piece before) of about PIECE_BYTES."""
    texts = texts.fill_null("")
    sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    first, size = 0, 0
    for i, n in enumerate(sizes.tolist()):
        if size and size + n > PIECE_BYTES:
            yield texts.slice(first, i - first), np.arange(first, i), np.zeros(i - first, dtype=bool)
            first, size = i, 0
        if n > PIECE_BYTES:
            for led, piece in _cut(texts[i].as_py()):
                yield pa.array([piece]), np.array([i]), np.array([led])
            first = i + 1
        else:
            size += n
    if first < len(sizes):
        yield texts.slice(first), np.arange(first, len(sizes)), np.zeros(len(sizes) - first, dtype=bool)


def _cut(text: str) -> Iterator[tuple[bool, str]]:
    step, at, lead = PIECE_BYTES // 4, 0, ""
    while at < len(text):
        gap = _BETWEEN.search(text, min(at + step, len(text)))
        end = gap.end() if gap else len(text)
        piece = f"{lead} {text[at:end]}" if lead else text[at:end]
        words = [w for w in _BETWEEN.split(piece) if w]
        yield bool(lead), piece
        lead, at = words[-1] if words else lead, end


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place of the text, bucket) of every run of one or two words, and which are single words."""
    pieces = pc.split_pattern_regex(pc.ascii_lower(texts), pattern=SEPARATORS)
    words, of = pc.list_flatten(pieces), pc.list_parent_indices(pieces)
    solid = pc.not_equal(words, "")
    coded, of = words.filter(solid).dictionary_encode(), of.filter(solid).to_numpy().astype(np.int64)
    if not len(of):
        return of, of, of.astype(bool)
    index, known = coded.indices.to_numpy().astype(np.int64), coded.dictionary
    data = [w.encode() for w in known.to_pylist()]
    crc = np.fromiter(map(zlib.crc32, data), dtype=np.uint32, count=len(data))
    size = pc.binary_length(known).to_numpy().astype(np.int64)
    single = (crc % BUCKETS).astype(np.int64)[index]
    pair_at = np.flatnonzero(of[1:] == of[:-1])
    codes, inverse = np.unique(index[pair_at] * len(data) + index[pair_at + 1], return_inverse=True)
    a, b = codes // max(len(data), 1), codes % max(len(data), 1)
    spaced = joined_crc(crc, np.full(len(crc), zlib.crc32(b" "), dtype=np.uint32), np.ones(len(crc), dtype=np.int64))
    short = size[b] <= 64
    pair_crc = np.zeros(len(codes), dtype=np.uint32)
    pair_crc[short] = joined_crc(spaced[a[short]], crc[b[short]], size[b[short]])
    for i in np.flatnonzero(~short).tolist():
        pair_crc[i] = zlib.crc32(data[b[i]], int(spaced[a[i]]))
    double = (pair_crc % BUCKETS).astype(np.int64)[inverse]
    is_single = np.concatenate((np.ones(len(single), dtype=bool), np.zeros(len(double), dtype=bool)))
    return np.concatenate((of, of[pair_at])), np.concatenate((single, double)), is_single


def own_features(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The features of documents (place, bucket, whether a single word), piece by piece."""
    for piece, places, led in text_pieces(texts):
        at, bucket, single = features(piece)
        if led.any():  # the leading word has been counted with the piece before
            keep = np.ones(len(at), dtype=bool)
            keep[np.flatnonzero(single)[:1]] = False
            at, bucket, single = at[keep], bucket[keep], single[keep]
        yield places[at], bucket, single


def bucket_counts(texts: DataFrame, text: str = "text") -> np.ndarray:
    """Features of all texts by bucket; as many numbers as there are buckets reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, dtype=np.int64)
        for batch in batches:
            for _, bucket, _ in own_features(batch.column(0)):
                total += np.bincount(bucket, minlength=BUCKETS)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["bucket", "n"])

    prepare_workers(texts.sparkSession)
    added = texts.select(F.col(text)).mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(BUCKETS, dtype=np.int64)
    for r in added.collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln of the smoothed share in the target over that in the corpus), in doubles."""
    own, wanted = float(corpus.sum() + BUCKETS), float(target.sum() + BUCKETS)
    quotient = ((t + 1.0) * own / ((s + 1.0) * wanted) for s, t in zip(corpus.tolist(), target.tolist()))
    return np.array([math.floor(1000 * math.log(q)) for q in quotient], dtype=np.int64)


def noise(doc_id: int | None, seed: int = SEED) -> int:
    """A Gumbel draw in thousandths, from the id alone."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def weighted(docs: DataFrame, gain: np.ndarray, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc_id, n_words, n_features, weight, score) of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, n, total = (np.zeros(batch.num_rows, dtype=np.int64) for _ in range(3))
            for place, bucket, single in own_features(batch.column(1)):
                order = np.argsort(place, kind="stable")
                place, single, gained = place[order], single[order], sent.value.take(bucket[order])
                starts = np.flatnonzero(np.diff(place, prepend=-1))
                if len(starts):
                    held = place[starts]
                    n[held] += np.diff(np.append(starts, len(place)))
                    n_words[held] += np.add.reduceat(single.astype(np.int64), starts)
                    total[held] += np.add.reduceat(gained, starts)
            weight = np.where(n > 0, total // np.maximum(n, 1), 0)
            drawn = np.array([noise(i) for i in batch.column(0).to_pylist()], dtype=np.int64)
            columns = [batch.column(0), n_words, n, weight, weight + drawn]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["doc_id", "n_words", "n_features", "weight", "score"])

    prepare_workers(docs.sparkSession)
    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text)).mapInArrow(
        run, "doc_id long, n_words long, n_features long, weight long, score long"
    )


def drawn(rows: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """``rows`` with ``rank``: the places of the highest scores among rows with enough words, null for the rest."""
    spark = rows.sparkSession
    able = F.col("n_words") >= least_words
    counts = rows.filter(able).groupBy("score").agg(F.count(F.lit(1)).alias("n")).collect()  # within +-SCORE_BOUND
    by_score = sorted(((r["score"], r["n"]) for r in counts), reverse=True)
    wanted = percent * sum(n for _, n in by_score) // 100
    before, ahead = 0, []
    for score, n in by_score:
        if before >= wanted:
            break
        ahead.append((score, before))
        before += n
    places = spark.createDataFrame(ahead, "at long, ahead long")
    least = ahead[-1][0] if ahead else None
    reached = able & (F.col("score") >= F.lit(least)) if ahead else F.lit(False)
    number = F.row_number().over(Window.partitionBy("score").orderBy(F.col("doc_id").asc_nulls_last()))
    some = rows.filter(reached).withColumn("own", number)
    some = some.join(F.broadcast(places), F.col("score") == F.col("at"))
    rank = F.col("ahead") + F.col("own")
    some = some.withColumn("rank", F.when(rank <= wanted, rank)).drop("own", "at", "ahead")
    return rows.filter(~reached).withColumn("rank", F.lit(None).cast("long")).unionByName(some)


def resampled(docs: DataFrame, target: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) of all documents, drawn towards the target's texts."""
    gain = gains(bucket_counts(docs), bucket_counts(target))
    return drawn(spool(weighted(docs, gain), "importance"))


def query(spark, sf_dir: str) -> DataFrame:
    """op11: a quarter of the documents, drawn towards the benchmark's texts."""
    found = resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank", "n_words")
