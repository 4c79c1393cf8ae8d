"""Token ids in training order: fixed-stride binary shards, filled through a keyed Feistel permutation.

1. Every task encodes its documents (each followed by an end id) into one stream and writes it, in compressed runs,
   to the shared folder together with each run's place in the stream. The totals per task, one number each, give every
   run its global place, so sequences of ``stride`` tokens are cut across documents without padding.
2. Sequence q of n goes to slot P(q), where P is a Feistel network over the smallest even-bit domain that holds n;
   values outside [0, n) are walked through the network again, so P is a bijection on [0, n). It needs the key only, no
   table, and has an inverse.
3. Slots are range-partitioned: a range is a run of whole shards, all of equal size by construction, so nothing can be
   skewed. Pieces travel as one compressed block per (map block, range). A range is laid out in memory and written shard
   by shard under a temporary name that is then moved, so a repeated task overwrites the same bytes.

A reader takes slots from any position with one seek per shard (``read_slots``): training resumes where it stopped.

Defined cases: null texts give no tokens, empty texts only the end id; repeated rows are kept; an empty table
gives no shard and no row; the last sequence is filled up with the end id; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.llm import bpe_files
from tripmill.llm.common import mix, prepare_workers, spool, table
from tripmill.sources.lake import fresh_dir

KEY = 0x5EED0F7A
STRIDE = 2048
SHARD_SLOTS = 1024
#: Shards of one range, that is of one writing task: 4 shards of 4 MB.
RANGE_SHARDS = 4
#: Tokens of one stored run, and stored tokens cut up together.
RUN_TOKENS = 1 << 20
CUT_TOKENS = 1 << 22
ROUNDS = 6

_U = np.uint64


@dataclass(frozen=True)
class Feistel:
    """A keyed bijection on [0, n)."""

    n: int
    key: int

    @property
    def half(self) -> int:
        return max(1, (max(self.n - 1, 1).bit_length() + 1) // 2)

    def _round(self, x: np.ndarray, i: int) -> np.ndarray:
        return mix(x, self.key * 31 + i) & _U((1 << self.half) - 1)

    def _once(self, x: np.ndarray, rounds) -> np.ndarray:
        low = _U((1 << self.half) - 1)
        left, right = x >> _U(self.half), x & low
        for i in rounds:
            left, right = right, left ^ self._round(right, i)
        return right << _U(self.half) | left  # the halves swapped, so the reversed rounds undo it

    def _walk(self, x: np.ndarray, rounds) -> np.ndarray:
        out = self._once(np.asarray(x, dtype=_U), rounds)
        outside = out >= _U(self.n)
        while outside.any():
            out[outside] = self._once(out[outside], rounds)
            outside = out >= _U(self.n)
        return out.astype(np.int64)

    def slot(self, sequence: np.ndarray) -> np.ndarray:
        return self._walk(sequence, range(ROUNDS))

    def sequence(self, slot: np.ndarray) -> np.ndarray:
        return self._walk(slot, range(ROUNDS - 1, -1, -1))


@dataclass(frozen=True)
class Shards:
    """A written corpus: where it is and how to address it."""

    root: str
    n_sequences: int
    stride: int
    shard_slots: int
    key: int

    def path(self, shard: int) -> str:
        return f"{self.root}/shard-{shard:08d}.bin"


def token_runs(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    """(part, start, n, payload): each task's token stream in compressed runs of 16-bit ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = bpe_files.encoding(path).encode_ordinary
        part, start, held, size = TaskContext.get().partitionId(), 0, [], 0

        def flush() -> pa.RecordBatch:
            data = np.array(held, dtype="<u2").tobytes()
            packed = zstandard.compress(data, 6)
            return pa.RecordBatch.from_pydict({"part": [part], "start": [start], "n": [size], "payload": [packed]})

        for batch in batches:
            for text in batch.column(0).to_pylist():
                if text is None:
                    continue
                ids = encode(text)
                held += ids
                held.append(end_id)
                size += len(ids) + 1
                if size >= RUN_TOKENS:
                    yield flush()
                    start, held, size = start + size, [], 0
        if size:
            yield flush()

    prepare_workers(docs.sparkSession)
    return docs.select("text").mapInArrow(run, "part long, start long, n long, payload binary")


def cut(runs: DataFrame, bases: dict[int, int], order: Feistel, stride: int, range_slots: int) -> DataFrame:
    """Pieces of sequences, grouped by the range of slots they belong to."""

    def pack(pending: list[tuple[int, np.ndarray]]) -> Iterator[tuple]:
        slots, offsets, lengths, pieces = [], [], [], []
        for begin, tokens in pending:
            edges = np.arange(begin // stride, (begin + len(tokens) - 1) // stride + 1)
            first = np.maximum(edges * stride, begin)
            last = np.minimum((edges + 1) * stride, begin + len(tokens))
            slots.append(order.slot(edges))
            offsets.append(first - edges * stride)
            lengths.append(last - first)
            pieces += [tokens[a:b] for a, b in zip((first - begin).tolist(), (last - begin).tolist())]
        slot, offset, length = (np.concatenate(x) for x in (slots, offsets, lengths))
        by = np.argsort(slot, kind="stable")
        bounds = np.flatnonzero(np.diff(slot[by] // range_slots)) + 1
        for group in np.split(by, bounds):
            blob = b"".join(pieces[i].tobytes() for i in group.tolist())
            yield (
                int(slot[group[0]]) // range_slots,
                slot[group].astype("<i8").tobytes(),
                offset[group].astype("<i4").tobytes(),
                length[group].astype("<i4").tobytes(),
                zstandard.compress(blob, 3),
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending, size = [], 0
        names = ["range", "slots", "offsets", "lengths", "blob"]
        types = [pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.binary()]

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*pack(pending)), types)], names=names)

        for batch in batches:
            for row in batch.to_pylist():
                tokens = np.frombuffer(zstandard.decompress(row["payload"]), dtype="<u2")
                pending.append((bases[row["part"]] + row["start"], tokens))
                size += len(tokens)
                if size >= CUT_TOKENS:
                    yield out()
                    pending, size = [], 0
        if pending:
            yield out()

    return runs.mapInArrow(run, "range long, slots binary, offsets binary, lengths binary, blob binary")


def write_ranges(pieces: DataFrame, shards: Shards, total: int, range_slots: int, end_id: int) -> DataFrame:
    """Lays out each range, writes its shards and returns one row per slot, hashed as read back from the file."""
    order, stride = Feistel(shards.n_sequences, shards.key), shards.stride

    def write(group: pd.DataFrame) -> pd.DataFrame:
        number = int(group["range"].iloc[0])
        low = number * range_slots
        high = min(low + range_slots, shards.n_sequences)
        grid = np.full((high - low) * stride, end_id, dtype="<u2")
        filled = 0
        for slots, offsets, lengths, blob in zip(group["slots"], group["offsets"], group["lengths"], group["blob"]):
            tokens = np.frombuffer(zstandard.decompress(blob), dtype="<u2")
            size = np.frombuffer(lengths, dtype="<i4").astype(np.int64)
            to = (np.frombuffer(slots, dtype="<i8") - low) * stride + np.frombuffer(offsets, dtype="<i4")
            starts = np.cumsum(size) - size
            grid[np.arange(len(tokens)) + np.repeat(to - starts, size)] = tokens
            filled += len(tokens)
        sequences = order.sequence(np.arange(low, high))
        expected = int(np.minimum(total - sequences * stride, stride).sum())
        if filled != expected:
            raise ValueError(f"range {number} received {filled} of {expected} tokens")
        store, root = fs.FileSystem.from_uri(shards.root)
        rows = []
        for first in range(low, high, shards.shard_slots):
            last = min(first + shards.shard_slots, high)
            shard = first // shards.shard_slots
            name = f"{root}/shard-{shard:08d}.bin"
            attempt = f"{name}.{TaskContext.get().taskAttemptId()}"
            with store.open_output_stream(attempt) as sink:
                sink.write(grid[(first - low) * stride : (last - low) * stride].tobytes())
            store.move(attempt, name)
            with store.open_input_file(name) as source:
                stored = source.read()
            width = 2 * stride
            for i in range(last - first):
                record = stored[i * width : (i + 1) * width]
                rows.append((first + i, int(sequences[first - low + i]), shard, i * width, hashlib.sha256(record).hexdigest()))
        return pd.DataFrame(rows, columns=["slot", "sequence", "shard", "byte_offset", "sha256"])

    schema = "slot long, sequence long, shard long, byte_offset long, sha256 string"
    return pieces.groupBy("range").applyInPandas(write, schema)


def write_training_order(
    docs: DataFrame,
    root: str,
    path: str | None = None,
    key: int = KEY,
    stride: int = STRIDE,
    shard_slots: int = SHARD_SLOTS,
    end_id: int | None = None,
) -> tuple[Shards, DataFrame]:
    """Writes the shards below ``root`` (a URI all executors reach) when the returned frame is evaluated."""
    spark = docs.sparkSession
    path = path or bpe_files.default_path()
    end_id = max(bpe_files.ranks(path).values()) + 1 if end_id is None else end_id
    if end_id > 0xFFFF:
        raise ValueError("ids need more than 16 bits")
    runs = spool(token_runs(docs, path, end_id), "token-runs")
    bases, total = {}, 0
    # One number per task of the first pass.
    for row in runs.groupBy("part").agg(F.sum("n").alias("n")).orderBy("part").collect():
        bases[row["part"]] = total
        total += row["n"]
    shards = Shards(root, -(-total // stride), stride, shard_slots, key)
    range_slots = shard_slots * RANGE_SHARDS
    store, folder = fs.FileSystem.from_uri(root)
    store.create_dir(folder, recursive=True)
    pieces = cut(runs, bases, Feistel(max(shards.n_sequences, 1), key), stride, range_slots)
    return shards, write_ranges(pieces, shards, total, range_slots, end_id)


def read_slots(shards: Shards, start: int, stop: int | None = None) -> Iterator[np.ndarray]:
    """Sequences of slots [start, stop) in order, reading each shard forward from the first slot wanted."""
    store, root = fs.FileSystem.from_uri(shards.root)
    stop = shards.n_sequences if stop is None else min(stop, shards.n_sequences)
    width = 2 * shards.stride
    while start < stop:
        shard, at = divmod(start, shards.shard_slots)
        last = min((shard + 1) * shards.shard_slots, stop)
        with store.open_input_file(f"{root}/shard-{shard:08d}.bin") as source:
            source.seek(at * width)
            for _ in range(start, last):
                yield np.frombuffer(source.read(width), dtype="<u2")
        start = last


def query(spark, sf_dir: str) -> DataFrame:
    """op5: all documents written in training order; one row per slot, hashed as stored."""
    return write_training_order(table(spark, sf_dir, "documents"), fresh_dir(spark, "training-order"))[1]
