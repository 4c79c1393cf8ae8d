"""What the operators share: reading columns whatever their names, byte blocks, mixing and bounded samples."""

from __future__ import annotations

import ctypes
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from functools import wraps
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.sources.lake import materialize

#: Rows of one Arrow batch; texts are long, so batches of the default 10,000 rows can be too large.
BATCH_ROWS = 512
#: Bytes of one Arrow batch: some texts are very long.
BATCH_BYTES = 4 << 20
#: Text bytes an operator works on at a time inside a batch.
BLOCK_BYTES = 4 << 20

_U = np.uint64
_shipped: set[str] = set()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prepare_workers(spark: SparkSession) -> None:
    """Ship this package to the Python workers once per application, and bound the rows and bytes of an Arrow batch."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = Path(__file__).resolve().parents[1]
        archive = Path(tempfile.mkdtemp(prefix="py-files-")) / f"{package.name}.zip"  # Spark serves it to the executors
        with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as packed:
            for source in sorted(package.rglob("*.py")):
                packed.write(source, source.relative_to(package.parent))
        context.addPyFile(str(archive))
        _shipped.add(context.applicationId)


def hand_back() -> None:
    """Gives memory that Arrow and the C library hold unused back to the system: Python workers outlive their tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


def frees(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A map over batches that hands unused memory back at its end."""

    @wraps(run)
    def freed(batches: Iterator) -> Iterator:
        yield from run(batches)
        hand_back()

    return freed


def spool(df: DataFrame, name: str) -> DataFrame:
    """Written to the shared folder once and read again: cuts the lineage, so a lost executor costs a re-read."""
    return materialize(df, f"llm-{name}")


def free_name(df: DataFrame, wanted: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def crc_mod(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; null for a null id."""
    return F.crc32(doc_id.cast("string")) % F.lit(modulus)


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijective scramble of 64-bit words (xor-shift and multiply rounds)."""
    with np.errstate(over="ignore"):
        x = x.astype(_U, copy=True) + _U((salt * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & 0xFFFFFFFFFFFFFFFF)
        x ^= x >> _U(30)
        x *= _U(0xBF58476D1CE4E5B9)
        x ^= x >> _U(27)
        x *= _U(0x94D049BB133111EB)
        x ^= x >> _U(31)
    return x


def blocks(texts: list[str | None], limit: int = BLOCK_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """UTF-8 texts (null as empty) in runs of about ``limit`` bytes, each with the place of its first."""
    first, size, run = 0, 0, []
    for i, text in enumerate(texts):
        data = text.encode("utf-8", "surrogatepass") if text else b""
        if run and size + len(data) > limit:
            yield first, run
            first, size, run = i, 0, []
        run.append(data)
        size += len(data)
    if run:
        yield first, run


def bounded_sample(df: DataFrame, key: Column, by: str, per_group: int) -> DataFrame:
    """About ``per_group`` rows of each value of ``by`` at most, picked by a hash of ``key``.

    Only the number of rows of each value reaches the driver. Groups below the bound are kept whole.
    """
    counts = {r[by]: r["n"] for r in df.groupBy(by).agg(F.count(F.lit(1)).alias("n")).collect()}
    share = F.lit(0.0)
    for value, n in counts.items():
        share = F.when(F.col(by) == F.lit(value), F.lit(min(1.0, per_group / n))).otherwise(share)
    place = F.pmod(F.xxhash64(key, F.lit("sample")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return df.filter(place < share)


#: Bytes hashed at a time; a longer text is taken in pieces that end between words.
PIECE_BYTES = 1 << 20
_MULTIPLIER = 0x9E3779B97F4A7C55
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)
_BYTE_CODES = mix(np.arange(256, dtype=_U), 77)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_powers: list[np.ndarray] = []


def _powers_up_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        size = max(n, PIECE_BYTES + (1 << 16))
        steps = np.repeat(np.array([[_MULTIPLIER], [_INVERSE]], dtype=_U), size, axis=1)
        steps[:, 0] = 1
        with np.errstate(over="ignore"):
            _powers[:] = np.cumprod(steps, axis=1, dtype=_U)
    return _powers[0], _powers[1]


def pieces(data: np.ndarray) -> Iterator[tuple[int, int]]:
    """Bounds of runs of about PIECE_BYTES that end at white space."""
    first = 0
    while first < len(data):
        last = min(first + PIECE_BYTES, len(data))
        while last < len(data) and not _SPACE[data[last]]:
            ahead = np.flatnonzero(_SPACE[data[last : last + PIECE_BYTES]])
            last = last + int(ahead[0]) if len(ahead) else min(last + PIECE_BYTES, len(data))
        yield first, last
        first = last


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words (runs without ASCII white space) of a byte array, and where each begins."""
    hashes, begins = [], []
    with np.errstate(over="ignore"):
        for first, last in pieces(data):
            part = data[first:last]
            solid = ~_SPACE[part]
            edge = np.flatnonzero(np.diff(np.concatenate(([False], solid, [False])).view(np.int8)))
            start, end = edge[::2], edge[1::2]
            if not len(start):
                continue
            power, inverse = _powers_up_to(len(part))
            total = np.concatenate((np.zeros(1, dtype=_U), np.cumsum(_BYTE_CODES[part] * power[: len(part)], dtype=_U)))
            hashes.append(mix((total[end] - total[start]) * inverse[start], 5))
            begins.append(start + first)
    if not hashes:
        return np.zeros(0, dtype=_U), np.zeros(0, dtype=np.int64)
    return np.concatenate(hashes), np.concatenate(begins)


#: Bits of one row of a filter under construction.
CHUNK_BITS = 1 << 18


class HashFilter:
    """A bit per hash value of fixed total size: it may let a value through, it never holds one back."""

    def __init__(self, bits: int, chunks: dict[int, bytes]):
        self.shift = np.uint64(64 - bits.bit_length() + 1)
        self.words = np.zeros(max(bits, CHUNK_BITS) // 8, dtype=np.uint8)
        for chunk, data in chunks.items():
            self.words[chunk * CHUNK_BITS // 8 :][: len(data)] = np.frombuffer(data, dtype=np.uint8)

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        place = (mix(hashes, 99) >> self.shift).astype(np.int64)
        return (self.words[place >> 3] >> (place & 7).astype(np.uint8)) & 1 > 0


def hash_filter(hashes: DataFrame, column: str, expected: int, most_bits: int = 1 << 27) -> HashFilter:
    """A filter over a long column, built in parts in Spark; at most ``most_bits`` bits (16 MB) reach the driver."""
    bits = CHUNK_BITS
    while bits < min(most_bits, 16 * expected):
        bits *= 2
    shift = np.uint64(64 - bits.bit_length() + 1)

    def mark(batches):
        seen: dict[int, np.ndarray] = {}
        for batch in batches:
            place = (mix(batch["h"].to_numpy().astype(np.int64).view(_U), 99) >> shift).astype(np.int64)
            for chunk in np.unique(place // CHUNK_BITS).tolist():
                own = seen.setdefault(chunk, np.zeros(CHUNK_BITS, dtype=bool))
                own[place[place // CHUNK_BITS == chunk] % CHUNK_BITS] = True
        for chunk, own in seen.items():
            yield pd.DataFrame({"chunk": [chunk], "data": [np.packbits(own, bitorder="little").tobytes()]})

    def join(group: pd.DataFrame) -> pd.DataFrame:
        data = np.bitwise_or.reduce([np.frombuffer(d, dtype=np.uint8) for d in group["data"]])
        return pd.DataFrame({"chunk": group["chunk"].iloc[:1], "data": [data.tobytes()]})

    parts = (
        hashes.filter(F.col(column).isNotNull())
        .select(F.col(column).alias("h"))
        .mapInPandas(mark, "chunk long, data binary")
        .groupBy("chunk")
        .applyInPandas(join, "chunk long, data binary")
    )
    return HashFilter(bits, {r["chunk"]: bytes(r["data"]) for r in parts.collect()})
