"""Spelling variants: words one edit apart, found by dynamic programming over sorted lists.

Two words one edit apart agree before the edit and behind it. A word of m or m + 1 code points is therefore filed under
what it shares with partners whose shorter word has m: the part before a span of places, and the part behind it. At first
the spans are the two halves of the word; a block of more than BLOCK_WORDS words is filed anew under the halves of its
span, until a span is one place and its words differ in two letters at most. So blocks are bounded at any size of the
vocabulary, none is broadcast, and no pair is lost; a pair counts in the one span that holds its edit.

Within a block words are sorted (backwards where the shared part is the end). Each word is compared with those after it:
rows of the edit matrix, three cells wide, are kept for every prefix length and reused up to the common prefix of
neighbours in the list, and once a row's cells all exceed one edit, the whole range sharing that prefix is skipped.

A chosen form has at least RATIO times the occurrences, so chains of forms have at most log(occurrences) links and the
last form is found by pointer jumping in a few rounds.

Defined cases: null texts have no words; a null id is hashed as an empty one; repeated rows count each time; ties between
near words go to the smaller one in code-point order; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.llm.common import prepare_workers, spool, table

LEAST_LENGTH = 6
LEAST_COUNT = 5
RATIO = 5
MODULUS = 199
#: Words compared with each other in one list; larger blocks are split by what they share.
BLOCK_WORDS = 2048
#: Filed words compared by one task: the work is in comparing, so tasks are dealt by rows, not by bytes.
TASK_WORDS = 40_000
#: Characters of a text counted at a time, and words counted before they are passed on.
PIECE_CHARS = 1 << 20
MOST_COUNTED = 500_000

# The letters of a word; only A-Z are lowered.
_RUN = re.compile("[A-Za-zÀ-ÿ]+")
_LOWER = {c: c + 32 for c in range(65, 91)}
_LAST = "\U0010ffff"


def _pieces(text: str) -> Iterator[str]:
    """A text in parts that end outside of words."""
    at = 0
    while at < len(text):
        end = min(at + PIECE_CHARS, len(text))
        if end < len(text):
            inside = _RUN.match(text, end)
            end = inside.end() if inside else end
        yield text[at:end]
        at = end


def altered(run: str, crc_of_id: int) -> str:
    """The run, or the run less one code point where the checksum of id and run says so."""
    h = zlib.crc32(run.encode(), crc_of_id)
    if h % MODULUS:
        return run
    place = h % len(run)
    return run[:place] + run[place + 1 :]


def vocabulary(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(word, n): words of at least LEAST_LENGTH code points that occur at least LEAST_COUNT times."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()

        def passed() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], names=["word", "n"])
            total.clear()
            return out

        for batch in batches:
            for doc_id, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                crc = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                for piece in _pieces(data or ""):
                    for own, n in Counter(_RUN.findall(piece.translate(_LOWER))).items():
                        if len(own) >= LEAST_LENGTH:
                            word = altered(own, crc)
                            if len(word) >= LEAST_LENGTH:
                                total[word] += n
                    if len(total) > MOST_COUNTED:
                        yield passed()
        yield passed()

    prepare_workers(docs.sparkSession)
    counted = docs.select(F.col(key), F.col(text)).mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST_COUNT)


def common_prefix(a: str, b: str) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n  # a[:low] == b[:low], a[:high] != b[:high]
    while high - low > 1:
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


def near_in(words: list[str]) -> Iterator[tuple[int, int]]:
    """Places i < j of a sorted list of distinct words whose words are one edit apart."""
    n = len(words)
    shared = [0] * n  # code points in common with the word before
    for i in range(1, n):
        shared[i] = common_prefix(words[i - 1], words[i])
    # rows[d]: edits between a prefix of d code points and the query's prefixes of d - 1, d and d + 1
    rows: list[tuple[int, int, int]] = [(2, 0, 1)]
    for i in range(n - 1):
        query, length = words[i], len(words[i])
        while len(rows) <= length:
            rows.append((1, 0, 1))
        for d in range(1, length + 1):
            rows[d] = (1, 0, 1)
        j, depth = i + 1, shared[i + 1]
        while j < n:
            word = words[j]
            size = len(word)
            while len(rows) <= size:
                rows.append((2, 2, 2))
            skip = 0
            while depth < size:
                before, same, after = rows[depth]
                c = word[depth]
                depth += 1
                # out of the band, or of the query, cells count as two edits
                x = min(before + (query[depth - 2] != c) if 2 <= depth <= length + 1 else depth, same + 1)
                y = min(same + (query[depth - 1] != c), after + 1, x + 1) if depth <= length else 2
                z = min(after + (query[depth] != c), y + 1) if depth < length else 2
                rows[depth] = (x, y, z)
                if x > 1 and y > 1 and z > 1:
                    skip = depth
                    break
            if skip:
                # Every word that begins like this one up to the row is out.
                j += 1
                if j < n and shared[j] >= skip:
                    j = bisect_left(words, word[:skip] + _LAST, j)
            else:
                off = length - size
                if -1 <= off <= 1 and rows[size][off + 1] == 1:
                    yield i, j
                j += 1
            if j < n:
                depth = min(depth, shared[j])


def _filed(a: int, b: int, m: int, word: str) -> tuple[str, str]:
    """What a word shares with its partners: the part before place a and the part behind place b of the shorter word."""
    return word[:a], word[len(word) - (m - b) :] if b < m else ""


def _files(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Each word under the halves of its own length and of one less, or of the span of its block."""
    for batch in batches:
        out = []
        if "m" in batch:
            for word, n, m, a, b in zip(batch["word"], batch["n"], batch["m"], batch["a"], batch["b"]):
                middle = (a + b) // 2
                out += [(word, n, m, lo, hi, *_filed(lo, hi, m, word)) for lo, hi in ((a, middle), (middle, b))]
        else:
            for word, n in zip(batch["word"], batch["n"]):
                for m in (len(word) - 1, len(word)):
                    out += [(word, n, m, lo, hi, *_filed(lo, hi, m, word)) for lo, hi in ((0, m // 2), (m // 2, m))]
        yield pd.DataFrame(out, columns=["word", "n", "m", "a", "b", "head", "tail"])


def _compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Near pairs of the blocks of a sorted partition, and the words of blocks that are too large."""
    block: list[tuple[str, int]] = []
    file: tuple | None = None
    large = False

    def pairs() -> Iterator[tuple]:
        if len(block) < 2 or all(len(w) != file[1] for w, _ in block):
            return
        _, m, a, b = file
        backwards = m - b > a
        order = sorted((w[::-1] if backwards else w, w, n) for w, n in block)
        for i, j in near_in([o[0] for o in order]):
            (_, u, nu), (_, v, nv) = order[i], order[j]
            if min(len(u), len(v)) == m and a <= min(common_prefix(u, v), m - 1) < b:
                yield (u, nu, m, a, b, v, nv)

    columns = ["word", "n", "m", "a", "b", "other", "other_n"]
    for batch in batches:
        out = []
        for key, word, n, m, a, b in zip(batch["key"], batch["word"], batch["n"], batch["m"], batch["a"], batch["b"]):
            if (key, m, a, b) != file:
                out += pairs()
                block, file, large = [], (key, m, a, b), False
            if large:
                out.append((word, n, m, a, b, None, None))
                continue
            block.append((word, n))
            if len(block) > BLOCK_WORDS and b - a > 1:
                out += [(w, k, m, a, b, None, None) for w, k in block]
                block, large = [], True
        yield _frame(out, columns)
    yield _frame(list(pairs()), columns)


def _frame(rows: list[tuple], columns: list[str]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=columns)
    return out.astype({"n": "int64", "m": "int64", "a": "int64", "b": "int64", "other_n": "Int64"})


def near_pairs(words: DataFrame) -> DataFrame:
    """(word, n, other, other_n): all pairs of words one edit apart, each once."""
    prepare_workers(words.sparkSession)
    filed_as = "word string, n long, m long, a long, b long, head string, tail string"
    waiting, found = words.select("word", "n"), None
    while True:
        tasks = max(int(words.sparkSession.conf.get("spark.sql.shuffle.partitions")), 4 * waiting.count() // TASK_WORDS)
        filed = waiting.mapInPandas(_files, filed_as).withColumn("key", F.xxhash64("m", "a", "b", "head", "tail"))
        met = (
            filed.repartition(tasks, "key")
            .sortWithinPartitions("key", "m", "a", "b")
            .select("key", "word", "n", "m", "a", "b")
            .mapInPandas(_compare, "word string, n long, m long, a long, b long, other string, other_n long")
        )
        met = spool(met, "spelling")
        pairs = met.filter(F.col("other").isNotNull()).select("word", "n", "other", "other_n")
        found = pairs if found is None else found.unionByName(pairs)
        waiting = met.filter(F.col("other").isNull()).select("word", "n", "m", "a", "b")
        if waiting.isEmpty():
            return found


def last_forms(forms: DataFrame) -> DataFrame:
    """(word, root): where following forms ends, by doubling the distance in every round."""
    current = forms.select("word", F.col("form").alias("root"))
    while True:
        step = current.select(F.col("word").alias("root"), F.col("root").alias("further"))
        current = spool(current.join(step, "root", "left").select("word", "root", "further"), "forms")
        done = current.filter(F.col("further").isNotNull()).isEmpty()
        current = current.select("word", F.coalesce("further", "root").alias("root"))
        if done:
            return current


def variants(docs: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of the vocabulary."""
    words = spool(vocabulary(docs), "vocabulary")
    pairs = near_pairs(words)
    both = pairs.unionByName(
        pairs.select(F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n"))
    )
    near = both.groupBy("word", "n").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("word"))).alias("best")
    )
    chosen = -F.col("best.less") >= RATIO * F.col("n")
    near = spool(
        near.select(
            "word", "n_near", F.when(chosen, F.col("best.word")).alias("form"), F.when(chosen, -F.col("best.less")).alias("form_n")
        ),
        "near",
    )
    roots = last_forms(near.filter(F.col("form").isNotNull()))
    out = words.join(near, "word", "left").join(roots, "word", "left")
    return out.select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n"
    )


def query(spark, sf_dir: str) -> DataFrame:
    """op12: spelling variants among the words of all documents."""
    return variants(table(spark, sf_dir, "documents"))
