"""Byte-level BPE: merges replayed in rank order over an inverted index from token pair to word positions.

A block of documents is split by the pattern and each distinct word is kept once. All words of the block lie in one
array of tokens with links to the next and the previous token. An inverted index lists, for every adjacent pair whose
joined bytes are a vocabulary entry, the positions where it stands. Ranks are then visited in ascending order; all
positions of a rank are merged at once, and only the pairs with the touched neighbours enter the index. The texts are
assembled from the word encodings. Nothing is shuffled, memory is bounded by the block, and a lost task is repeated
from its input alone.

Within a word the library always merges the leftmost pair of lowest rank. The replay gives the same, unless a merge
creates a pair of a lower rank than its own (vocabularies allow it); such words are marked and done one by one.

Defined cases: null and empty texts encode to no ids and decode to nothing; repeated rows give repeated results; an
empty table gives no rows; words of any length are handled (a repeated letter is merged in runs); other columns
are not read.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.llm import bpe_files
from tripmill.llm.common import BLOCK_BYTES, blocks, frees, prepare_workers, table

END = -1


class Vocabulary:
    """Ranks of a file, token bytes by id, and the joined rank of every pair of tokens that has one."""

    def __init__(self, path: str):
        self.rank = bpe_files.ranks(path)
        size = max(self.rank.values()) + 1
        self.bytes = [b""] * size
        for token, rank in self.rank.items():
            self.bytes[rank] = token
        self.byte_ids = np.array([self.rank[bytes([b])] for b in range(256)], dtype=np.int64)
        self.lengths = np.array([len(b) for b in self.bytes], dtype=np.int64)
        self.starts = np.concatenate(([0], np.cumsum(self.lengths)))[:-1]
        self.blob = np.frombuffer(b"".join(self.bytes), dtype=np.uint8)
        joined = {}
        for token, rank in self.rank.items():
            for cut in range(1, len(token)):
                left, right = self.rank.get(token[:cut]), self.rank.get(token[cut:])
                if left is not None and right is not None:
                    joined[left << 32 | right] = rank
        order = sorted(joined)
        self.pairs = np.array(order, dtype=np.int64)
        self.pair_ranks = np.array([joined[p] for p in order], dtype=np.int64)

    def joined_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each joined pair, END where there is none."""
        keys = left << 32 | right
        at = np.minimum(np.searchsorted(self.pairs, keys), max(len(self.pairs) - 1, 0))
        return np.where(self.pairs[at] == keys, self.pair_ranks[at], END) if len(self.pairs) else np.full(len(keys), END)


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def merge_one(word: bytes, vocab: Vocabulary) -> list[int]:
    """One word alone: the lowest rank first, the leftmost of equals, with a heap over a linked list."""
    rank, ids = vocab.rank, [int(vocab.byte_ids[b]) for b in word]
    n = len(ids)
    after, before, parts = list(range(1, n + 1)), list(range(-1, n - 1)), vocab.bytes
    alive = [True] * n
    heap: list[tuple[int, int, int, int]] = []

    def offer(i: int) -> None:
        if i >= 0 and after[i] < n:
            j = after[i]
            joined = rank.get(parts[ids[i]] + parts[ids[j]])
            if joined is not None:
                heapq.heappush(heap, (joined, i, ids[i], ids[j]))

    for i in range(n):
        offer(i)
    while heap:
        joined, i, left, right = heapq.heappop(heap)
        j = after[i] if alive[i] else n
        if j >= n or ids[i] != left or ids[j] != right:
            continue
        ids[i], alive[j] = joined, False
        after[i] = after[j]
        if after[i] < n:
            before[after[i]] = i
        offer(before[i])
        offer(i)
    return [x for x, live in zip(ids, alive) if live]


def replay(words: list[bytes], vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Encodings of distinct words as (ids, offsets): word w is ids[offsets[w]:offsets[w + 1]]."""
    sizes = np.array([len(w) for w in words], dtype=np.int64)
    ends = np.cumsum(sizes)
    n = int(ends[-1]) if len(words) else 0
    token = vocab.byte_ids[np.frombuffer(b"".join(words), dtype=np.uint8)]
    owner = np.repeat(np.arange(len(words)), sizes)
    after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
    after[ends[sizes > 0] - 1] = END
    before[(ends - sizes)[sizes > 0]] = END
    alive, odd = np.ones(n, dtype=bool), np.zeros(len(words), dtype=bool)

    index: dict[int, list[np.ndarray]] = {}
    waiting: list[int] = []

    def enter(positions: np.ndarray, ranks: np.ndarray) -> None:
        """File positions under the rank their pair joins to."""
        order = np.argsort(ranks, kind="stable")
        ranks, positions = ranks[order], positions[order]
        cuts = np.flatnonzero(np.diff(ranks)) + 1
        for r, group in zip(ranks[np.concatenate(([0], cuts))].tolist(), np.split(positions, cuts)):
            if r in index:
                index[r].append(group)
            else:
                index[r] = [group]
                heapq.heappush(waiting, r)

    def pairs_at(positions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        positions = positions[positions >= 0]
        positions = positions[after[positions] >= 0]
        ranks = vocab.joined_ranks(token[positions], token[after[positions]])
        return positions[ranks >= 0], ranks[ranks >= 0]

    if n:
        positions, ranks = pairs_at(np.arange(n))
        if len(positions):
            enter(positions, ranks)
    while waiting:
        rank = heapq.heappop(waiting)
        filed = index.pop(rank)
        at = np.unique(np.concatenate(filed)) if len(filed) > 1 else np.sort(filed[0])
        at = at[alive[at] & ~odd[owner[at]]]
        at = at[after[at] >= 0]
        at = at[vocab.joined_ranks(token[at], token[after[at]]) == rank]
        if not len(at):
            continue
        # Of occurrences that share a token, the leftmost merges, the next does not, and so on along the run.
        shares = np.concatenate(([False], after[at[:-1]] == at[1:]))
        if shares.any():
            run_start = np.maximum.accumulate(np.where(shares, 0, np.arange(len(at))))
            at = at[(np.arange(len(at)) - run_start) % 2 == 0]
        gone = after[at]
        token[at] = rank
        alive[gone] = False
        after[at] = after[gone]
        follow = after[at]
        before[follow[follow >= 0]] = at[follow >= 0]
        touched = np.unique(np.concatenate((before[at], at)))
        positions, ranks = pairs_at(touched)
        if len(positions):
            lower = ranks < rank
            if lower.any():
                odd[owner[positions[lower]]] = True
            enter(positions, ranks)

    counts = np.bincount(owner[alive], minlength=len(words)) if n else np.zeros(len(words), dtype=np.int64)
    if not odd.any():
        return token[alive], np.concatenate(([0], np.cumsum(counts)))
    alone = {int(w): merge_one(words[w], vocab) for w in np.flatnonzero(odd)}
    for w, ids in alone.items():
        counts[w] = len(ids)
    offsets = np.concatenate(([0], np.cumsum(counts)))
    out = np.empty(int(offsets[-1]), dtype=np.int64)
    kept = alive & ~odd[owner]
    plain = ~np.repeat(odd, counts)
    out[plain] = token[kept]
    for w, ids in alone.items():
        out[offsets[w] : offsets[w + 1]] = ids
    return out, offsets


def gather(values: np.ndarray, offsets: np.ndarray, picks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs ``picks`` of a packed array one after another, and where each begins."""
    sizes = offsets[picks + 1] - offsets[picks]
    starts = np.concatenate(([0], np.cumsum(sizes)))
    places = np.arange(starts[-1]) - np.repeat(starts[:-1] - offsets[picks], sizes)
    return values[places], starts


@lru_cache(maxsize=2)
def splitter(pattern: str):
    return regex.compile(pattern)


def encode_block(texts: list[str], path: str, pattern: str) -> tuple[np.ndarray, np.ndarray]:
    """(ids, offsets) of the texts of one block."""
    vocab, find = vocabulary(path), splitter(pattern).findall
    number: dict[str, int] = {}
    picks, per_text = [], [0]
    for text in texts:
        picks += [number.setdefault(w, len(number)) for w in find(text)]
        per_text.append(len(picks))
    words = [w.encode("utf-8") for w in number]
    whole = np.array([vocab.rank.get(w, END) for w in words], dtype=np.int64)  # a word that is an entry stays whole
    ids, offsets = replay([b"" if r >= 0 else w for w, r in zip(words, whole.tolist())], vocab)
    counts = np.where(whole >= 0, 1, np.diff(offsets))
    packed = np.empty(int(counts.sum()), dtype=np.int64)
    known = np.repeat(whole >= 0, counts)
    packed[~known], packed[known] = ids, whole[whole >= 0]
    out, starts = gather(packed, np.concatenate(([0], np.cumsum(counts))), np.array(picks, dtype=np.int64))
    return out, starts[np.array(per_text)]


def decode(ids: np.ndarray, vocab: Vocabulary) -> np.ndarray:
    """Bytes of a run of ids."""
    places = np.concatenate((vocab.starts, [len(vocab.blob)]))
    return gather(vocab.blob, places, ids.astype(np.int64))[0]


def encode_documents(
    docs: DataFrame, path: str | None = None, pattern: str = public_tokenizers.PATTERN, keep_ids: bool = False
) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) per document; with ``keep_ids`` also the ids as uint32 bytes."""
    path = path or bpe_files.default_path()
    columns = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * keep_ids
    types = [pa.int64(), pa.int64(), pa.string(), pa.string()] + [pa.binary()] * keep_ids

    @frees
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        for batch in batches:
            doc_ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            for first, run_of in blocks(texts, BLOCK_BYTES):
                ids, offsets = encode_block([t.decode("utf-8") for t in run_of], path, pattern)
                rows = []
                for i in range(len(run_of)):
                    own = ids[offsets[i] : offsets[i + 1]]
                    stored = own.astype("<u4").tobytes()
                    back = decode(own, vocab).tobytes()
                    digests = (hashlib.sha256(stored).hexdigest(), hashlib.sha256(back).hexdigest())
                    rows.append((doc_ids[first + i], len(own), *digests) + (stored,) * keep_ids)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=columns)

    prepare_workers(docs.sparkSession)
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids binary" * keep_ids
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


def query(spark, sf_dir: str) -> DataFrame:
    """op9: ids and round trip of all documents."""
    return encode_documents(table(spark, sf_dir, "documents"))
