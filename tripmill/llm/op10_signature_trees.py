"""Near-duplicate groups by word n-gram Jaccard similarity, joined through signature trees.

1. Every text becomes its set of shingle hashes and an OR-combined bitmap of them (signature). Equal sets share one id.
2. Candidates, without loss: two linked sets of sizes in one class differ in at most T shingles, so of T + 1 + E parts of
   the hash space E + 1 hold the same shingles on both sides. A set is posted under a key per part; parts with fewer than
   a few shingles ("thin") need no posting unless a set has more than E of them. Shingles that a sample shows to be
   common are left out first, which keeps the bound; the sample is a share of the corpus, so texts of a larger corpus are
   not chained together by phrases that they share by chance. Keys are packed per task and pre-aggregated there: sets of one task that share a key become a chain of edges, and one of them is posted on. So a
   key held by any share of the corpus costs one posting per task.
3. Sets connected by keys of one size class form candidate groups; a set is a member in every class it has keys in, so sets
   of unlike sizes are not chained together. In each group a signature tree is built (nodes: OR of bitmaps, range of
   sizes, most shingles lost to bit collisions); a dual traversal drops node pairs whose largest possible overlap is
   too small, and at the leaves compares signatures. Signatures are as wide as the sets of a class are large: full ones
   would let every pair through. What is connected by the pairs left forms narrower groups.
4. Only now the shingles of the sets in such groups are read again from their texts; the same traversal verifies
   pairs exactly and skips pairs that are connected already, so a group of n copies yields n - 1 links, never all pairs.
Groups of more than GROUP members or GROUP_BYTES bytes are cut into blocks, and every pair of blocks is a group of
its own for the task that reads it; the number of tasks follows the bytes that are read, not a setting.

Nothing but bit filters of bounded size (common shingles, which documents to read again) is broadcast; no list of documents,
links, shingles or components reaches the driver.

Defined cases: null and empty texts and texts without words have no shingles, link with nothing and are their own
component; a text with fewer words than a shingle is one shingle; rows that repeat an id stay rows, each linked by its own
text; rows without an id link with nothing and have no component; an empty table gives no rows; other columns
are not read. Shingles are compared by 64-bit hashes and whole sets by 128-bit digests.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.llm.common import (
    LOWER,
    PIECE_BYTES,
    HashFilter,
    blocks,
    frees,
    hand_back,
    hash_filter,
    mix,
    prepare_workers,
    spool,
    table,
    word_hashes,
)
from tripmill.llm.components import UnionFind, components, star_edges

WORDS = 3
#: Link at NUMERATOR / DENOMINATOR or more.
NUMERATOR, DENOMINATOR = 9, 10
#: Least and most bits of a signature.
SIGNATURE_BITS, MOST_SIGNATURE_BITS = 1024, 1 << 20
#: Members and bytes (signatures or shingles) of a group, or of one block of a larger group. Large groups are copied once
#: per block, so blocks are as large as the memory of a task allows that holds two of them.
GROUP, GROUP_BYTES = 4096, 64 << 20
#: Bytes of the signatures of a group or block: one wide member does not widen those of all others beyond it.
SIGNATURE_BYTES = 16 << 20
#: Groups of signatures are cut at FEW members already, into at most SPLIT blocks.
FEW, SPLIT = 512, 8
#: Bytes of blocks that one task reads, and bytes of texts whose keys meet in one task.
TASK_BYTES, PART_BYTES = 32 << 20, 32 << 20
LEAF, FAN = 32, 8
#: Words of signatures that are compared at a time.
WORDS_AT_A_TIME = 1 << 20
#: Shingles that COMMON_LEAST sampled documents hold are left out of keys where that can be; sampled are about SAMPLE documents
#: or one in SAMPLE_ONE_IN, whichever are more.
SAMPLE, SAMPLE_ONE_IN, COMMON_LEAST = 16_384, 16, 3
#: A task posts its keys when it has so many of them or so many sets.
POST_KEYS, POST_SETS = 1 << 20, 60_000
CLASS_RATIO = 1.5
#: A set's id in a class has the class in its highest bits.
CLASS_SHIFT = 56

_U = np.uint64


def shingle_sets(run: list[bytes], words: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    data = LOWER[np.frombuffer(b" ".join(run) + b" ", dtype=np.uint8)]
    ends = np.cumsum([len(d) + 1 for d in run])
    h, begins = word_hashes(data)
    bounds = np.searchsorted(begins, np.concatenate(([0], ends)))
    if len(h) >= words:
        n = len(h) - words + 1
        acc = np.zeros(n, dtype=_U)
        with np.errstate(over="ignore"):
            for k in range(words):
                acc = acc * _U(0x9E3779B97F4A7C55) + h[k : k + n]
        acc = mix(acc, words)
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if b - a >= words:
            out.append(np.unique(acc[a : b - words + 1]))
        elif b > a:
            whole = 0
            for x in h[a:b].tolist():
                whole = (whole * 0x9E3779B97F4A7C55 + x) & 0xFFFFFFFFFFFFFFFF
            out.append(mix(np.array([whole], dtype=_U), 1000 + b - a))
        else:
            out.append(np.zeros(0, dtype=_U))
    return out


def signature(shingles: np.ndarray, bits: int = SIGNATURE_BITS) -> np.ndarray:
    """OR of one bit per shingle, as 64-bit words."""
    flags = np.zeros(bits, dtype=np.uint8)
    flags[(mix(shingles, 3) % _U(bits)).astype(np.int64)] = 1
    return np.packbits(flags, bitorder="little").view(_U)


def class_bits(largest: int) -> int:
    """Bits per signature in a class of sets of up to ``largest`` shingles: with fewer bits than shingles, unlike sets pass."""
    return min(MOST_SIGNATURE_BITS, max(SIGNATURE_BITS, 1 << (largest - 1).bit_length()))


def folded(signatures: list[bytes]) -> np.ndarray:
    """Signatures as if all were made with as few bits as the narrowest (widths are powers of two)."""
    found = [np.frombuffer(s, dtype="<u8") for s in signatures]
    words = min(len(s) for s in found)
    return np.array([np.bitwise_or.reduce(s.reshape(-1, words), axis=0) for s in found])


def signature_bits(largest: int, members: int) -> int:
    """Bits per signature: twice the largest set, but no more than fit SIGNATURE_BYTES (collisions only cost pruning)."""
    fit = max(64, 8 * SIGNATURE_BYTES // members)
    return min(1 << 16, max(64, 1 << (2 * largest - 1).bit_length()), 1 << (fit.bit_length() - 1))


class Classes:
    """Size classes, and per class how many parts the hash space has and how many thin ones need no posting."""

    def __init__(self, numerator: int, denominator: int):
        self.p, self.q = numerator, denominator

    @lru_cache(maxsize=None)
    def bounds(self, c: int) -> tuple[int, int]:
        low = 1 if c == 0 else self.bounds(c - 1)[1] + 1
        return low, max(low, int(low * CLASS_RATIO) - 1)

    def of(self, size: int) -> int:
        c = 0
        while self.bounds(c)[1] < size:
            c += 1
        return c

    @lru_cache(maxsize=None)
    def parts(self, c: int) -> tuple[int, int, int]:
        """(parts, shingles from which a part is posted, thin parts that need none)."""
        low, high = self.bounds(c)
        most = (self.q - self.p) * 2 * high // (self.q + self.p)  # differing shingles of a linked pair
        if most == 0:
            return 1, 1, 0
        for least in (3, 2, 1):
            spare = 0
            for _ in range(20):
                m = most + 1 + spare
                rate = low / m
                thin = m * math.exp(-rate) * sum(rate**k / math.factorial(k) for k in range(least))
                wanted = math.ceil(thin + 4 * math.sqrt(thin))
                if wanted <= spare:
                    break
                spare = wanted
                if spare > 0.3 * most + 3:
                    break
            if spare <= 0.3 * most + 3 or least == 1:
                return most + 1 + spare, least, spare
        raise AssertionError

    @lru_cache(maxsize=1 << 14)
    def posted_in(self, size: int) -> tuple[int, ...]:
        """Classes in which the larger set of a linked pair with one of this size can be."""
        return tuple(range(self.of(size), self.of(size * self.q // self.p) + 1))

    def keys(self, shingles: np.ndarray, common: np.ndarray | HashFilter) -> np.ndarray:
        """Keys of a set in all classes."""
        found = [k for _, k in self.keys_by_class(shingles, common)]
        return np.concatenate(found) if found else np.zeros(0, dtype=_U)

    def keys_by_class(
        self, shingles: np.ndarray, common: np.ndarray | HashFilter
    ) -> Iterator[tuple[int, np.ndarray]]:
        """Keys of a set, class by class. ``common`` are shingles that many documents share, sorted or as a filter.

        Any fixed list will do.

        Linked sets differ in at most as many shingles without the common ones as with them, so parts of what is left
        do as well, and do not bring together all documents that quote one passage. Only sets for which
        too many parts become thin that way are posted under parts of the whole set too: of two such sets
        both are, and otherwise the one with enough parts meets the other.
        """
        if isinstance(common, HashFilter):
            own = shingles[~common.holds(shingles)]
        else:
            own = np.setdiff1d(shingles, common, assume_unique=True)
        for c in self.posted_in(len(shingles)):
            m, least, spare = self.parts(c)
            if m == 1:
                continue  # linked sets of this class are equal
            key, which, counts = self._parts(own, m)
            enough = counts >= least
            yield c, mix(key[enough] ^ mix(which[enough].astype(_U), 13 + c), 17)
            if m - enough.sum() <= spare:
                continue
            key, which, counts = self._parts(shingles, m)
            enough = counts >= least
            if m - enough.sum() > spare:  # thin parts as well then, and empty ones
                empty = np.setdiff1d(np.arange(m), which)
                key, which = np.concatenate((key, np.zeros(len(empty), dtype=_U))), np.concatenate((which, empty))
            else:
                key, which = key[enough], which[enough]
            yield c, mix(key ^ mix(which.astype(_U), 13 + c), 19)

    @staticmethod
    def _parts(shingles: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(key, part, size) of the parts that hold shingles."""
        if not len(shingles):
            return np.zeros(0, dtype=_U), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        part = ((shingles >> _U(32)) * _U(m) >> _U(32)).astype(np.int64)  # ascending, as the hashes are
        first = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
        with np.errstate(over="ignore"):
            key = np.add.reduceat(mix(shingles, 11), first)
        return key, part[first], np.diff(np.concatenate((first, [len(part)])))


class Tree:
    """Levels of nodes over members sorted by size; level 0 are the leaves."""

    def __init__(self, sizes: np.ndarray, signatures: np.ndarray):
        self.order = np.lexsort((*signatures.T[:2], sizes))
        self.sizes, self.signatures = sizes[self.order], signatures[self.order]
        self.lost = self.sizes - np.bitwise_count(self.signatures).sum(axis=1).astype(np.int64)
        self.levels = []
        low, high, lost, union, step = self.sizes, self.sizes, self.lost, self.signatures, LEAF
        while True:
            first = np.arange(0, len(low), step)
            low, high = np.minimum.reduceat(low, first), np.maximum.reduceat(high, first)
            lost, union = np.maximum.reduceat(lost, first), np.bitwise_or.reduceat(union, first, axis=0)
            self.levels.append((low, high, lost, union))
            if len(low) == 1:
                break
            step = FAN

    def members(self, leaf: int) -> slice:
        return slice(leaf * LEAF, (leaf + 1) * LEAF)


def _pairs_of(a: np.ndarray, b: np.ndarray, na: int, nb: int) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of children of node pairs."""
    grid = np.arange(FAN)
    left = (a[:, None, None] * FAN + grid[None, :, None] + 0 * grid[None, None, :]).ravel()
    right = (b[:, None, None] * FAN + 0 * grid[None, :, None] + grid[None, None, :]).ravel()
    inside = (left < na) & (right < nb)
    return left[inside], right[inside]


def dual_traversal(left: Tree, right: Tree, p: int, q: int) -> Iterator[tuple[int, int]]:
    """Pairs of leaves that may hold a linked pair; for one tree with itself, each pair of leaves once."""
    same = left is right
    depth = max(len(left.levels), len(right.levels)) - 1
    a = b = np.zeros(1, dtype=np.int64)
    for level in range(depth, -1, -1):
        la, lb = left.levels[min(level, len(left.levels) - 1)], right.levels[min(level, len(right.levels) - 1)]
        if level < depth:
            down_a, down_b = level < len(left.levels) - 1, level < len(right.levels) - 1
            if down_a and down_b:
                a, b = _pairs_of(a, b, len(la[0]), len(lb[0]))
            elif down_a or down_b:
                grid = np.arange(FAN)
                if down_a:
                    a, b = (a[:, None] * FAN + grid).ravel(), np.repeat(b, FAN)
                    a, b = a[a < len(la[0])], b[a < len(la[0])]
                else:
                    b, a = (b[:, None] * FAN + grid).ravel(), np.repeat(a, FAN)
                    a, b = a[b < len(lb[0])], b[b < len(lb[0])]
        if same:
            a, b = a[a <= b], b[a <= b]
        kept_a, kept_b = [], []
        step = min(4096, max(1, WORDS_AT_A_TIME // la[3].shape[1]))
        for i in range(0, len(a), step):
            x, y = a[i : i + step], b[i : i + step]
            common = np.bitwise_count(la[3][x] & lb[3][y]).sum(axis=1).astype(np.int64)
            overlap = common + np.minimum(la[2][x], lb[2][y])
            overlap = np.minimum(overlap, np.minimum(la[1][x], lb[1][y]))
            least = la[0][x] + lb[0][y]
            keep = overlap * (p + q) >= p * least
            keep &= (la[1][x] * q >= p * lb[0][y]) & (lb[1][y] * q >= p * la[0][x])
            kept_a.append(x[keep])
            kept_b.append(y[keep])
        a, b = np.concatenate(kept_a), np.concatenate(kept_b)
    yield from zip(a.tolist(), b.tolist())


def _shared_bits(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Bits that each row of ``a`` shares with each of ``b``."""
    step = max(1, WORDS_AT_A_TIME // b.size)
    runs = (np.bitwise_count(a[i : i + step, None, :] & b[None, :, :]).sum(axis=2) for i in range(0, len(a), step))
    return np.concatenate([r.astype(np.int64) for r in runs])


def join_trees(left: Tree, right: Tree, sets: UnionFind, place_a, place_b, p: int, q: int, verify=None) -> None:
    """Unites linked members in ``sets``; without ``verify`` those whose signatures allow a link."""
    same = left is right
    for x, y in dual_traversal(left, right, p, q):
        sa, sb = left.members(x), right.members(y)
        ia, ib = left.order[sa], right.order[sb]
        ra = np.array([sets.find(i) for i in place_a[ia].tolist()])
        rb = np.array([sets.find(i) for i in place_b[ib].tolist()])
        if ra.min() == ra.max() == rb.min() == rb.max():
            continue
        na, nb = left.sizes[sa], right.sizes[sb]
        common = _shared_bits(left.signatures[sa], right.signatures[sb])
        overlap = common + np.minimum(left.lost[sa][:, None], right.lost[sb][None, :])
        overlap = np.minimum(overlap, np.minimum(na[:, None], nb[None, :]))
        possible = overlap * (p + q) >= p * (na[:, None] + nb[None, :])
        possible &= ra[:, None] != rb[None, :]
        if same and x == y:
            possible = np.triu(possible, 1)
        for i, j in zip(*(w.tolist() for w in np.nonzero(possible))):
            u, v = int(place_a[ia[i]]), int(place_b[ib[j]])
            if sets.find(u) != sets.find(v) and (verify is None or verify(u, v)):
                sets.union(u, v)


def _digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


_FACTS = pa.schema(
    [
        ("doc_id", pa.int64()), ("n", pa.int64()), ("id", pa.int64()), ("digest", pa.binary()), ("sig", pa.binary()),
        ("part", pa.int64()), ("keys", pa.binary()), ("places", pa.binary()), ("ids", pa.binary()),
        ("a", pa.int64()), ("b", pa.int64()), ("text_key", pa.int64()), ("low", pa.int64()), ("high", pa.int64()),
        ("classes", pa.binary()),
    ]
)
_FACTS_SQL = (
    "doc_id long, n long, id long, digest binary, sig binary, part long, keys binary, places binary, ids binary, "
    "a long, b long, text_key long, low long, high long, classes binary"
)


def _batch(**columns) -> pa.RecordBatch:
    n = len(next(iter(columns.values())))
    return pa.RecordBatch.from_arrays(
        [pa.array(columns.get(f.name, [None] * n), f.type) for f in _FACTS], schema=_FACTS
    )


def _groups(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For sorted keys: where each run begins, and each place's run."""
    begins = np.concatenate(([True], keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, dtype=bool)
    return np.flatnonzero(begins), np.cumsum(begins) - 1


def _post(
    keys: np.ndarray, owner: np.ndarray, ids: np.ndarray, classes: np.ndarray, parts: int
) -> Iterator[pa.RecordBatch]:
    """Edges between sets of this task that share a key, and one posting per key."""
    order = np.argsort(keys, kind="stable")
    keys, owner = keys[order], owner[order]
    begins, run = _groups(keys)
    first = owner[begins][run]
    linked = first != owner
    a, b = star_edges(ids, first[linked], owner[linked])
    if len(a):
        yield _batch(a=a, b=b)
    keys, owner = keys[begins], owner[begins]
    part = (keys % _U(parts)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    rows = {"part": [], "keys": [], "places": [], "ids": [], "classes": []}
    for own in np.split(order, np.flatnonzero(np.diff(part[order])) + 1):
        if not len(own):
            continue
        used, place = np.unique(owner[own], return_inverse=True)
        # 40 bits, the part and the class tell keys apart well enough: a chance meeting is only a candidate of its class.
        rows["part"].append(int(part[own[0]]))
        rows["keys"].append((keys[own] >> _U(24)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5].tobytes())
        rows["places"].append(place.astype("<u2").tobytes())
        rows["ids"].append(ids[used].astype("<i8").tobytes())
        rows["classes"].append(classes[used].tobytes())
    if rows["part"]:
        yield _batch(**rows)


def _meet(group: pd.DataFrame) -> pd.DataFrame:
    """Edges between the sets posted under the same key of a class anywhere."""
    keys, owners = [], []
    for packed, places, ids, classes in zip(group["keys"], group["places"], group["ids"], group["classes"]):
        place = np.frombuffer(places, dtype="<u2")
        wide = np.zeros((len(place), 8), dtype=np.uint8)
        wide[:, :5] = np.frombuffer(packed, dtype=np.uint8).reshape(-1, 5)
        wide[:, 5] = np.frombuffer(classes, dtype=np.uint8)[place]
        keys.append(wide.view("<u8").ravel())
        owners.append(np.frombuffer(ids, dtype="<i8")[place])
    keys, owners = np.concatenate(keys), np.concatenate(owners)
    order = np.argsort(keys, kind="stable")
    keys, owners = keys[order], owners[order]
    begins, run = _groups(keys)
    first = owners[begins][run]
    linked = first != owners
    left, right = first[linked], owners[linked]
    names = np.unique(np.concatenate((left, right)))
    a, b = star_edges(names, np.searchsorted(names, left), np.searchsorted(names, right))
    return pd.DataFrame({"a": a, "b": b})


def _blocked(
    members: DataFrame, group: str, spread: str, weight: Column, split: int = 1, most: int | None = None
) -> tuple[DataFrame, int]:
    """Members with (group, lo, hi), a group each or a pair of blocks of a large group, and how many tasks are to read them.

    ``weight`` is a member's bytes, ``most`` those of a block (GROUP_BYTES if not given). A group of b blocks holds every member b times; the number of tasks is told by the
    bytes of all copies, so what one task reads does not grow with the corpus.
    """
    sizes = members.groupBy(group).agg(F.count(F.lit(1)).alias("_members"), F.sum(weight).alias("_bytes"))
    few = F.least(F.ceil(F.col("_members") / F.lit(FEW)), F.lit(split))
    many = F.greatest(F.ceil(F.col("_members") / F.lit(GROUP)), F.ceil(F.col("_bytes") / F.lit(most or GROUP_BYTES)))
    sizes = sizes.select(
        group, F.col("_bytes"), F.least(F.greatest(few, many), F.col("_members")).cast("long").alias("_blocks")
    )
    read = sizes.agg(F.sum(F.col("_bytes") * F.col("_blocks"))).first()[0] or 0
    tasks = max(int(members.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-int(read) // TASK_BYTES))
    own = F.pmod(F.xxhash64(spread), F.col("_blocks"))
    pairs = F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1),
        lambda other: F.struct(F.least(own, other).alias("lo"), F.greatest(own, other).alias("hi")),
    )
    blocked = (
        members.join(sizes, group)
        .withColumns({"own": own, "_pair": F.explode(pairs)})
        .withColumns({"lo": F.col("_pair.lo"), "hi": F.col("_pair.hi")})
        .drop("_pair", "_blocks", "_bytes")
    )
    return blocked, tasks


def _forest(frame: pd.DataFrame, name: str, p: int, q: int, with_sets: bool) -> pd.DataFrame:
    """Contracted edges between the members of one group, or between its two blocks."""
    frame = frame.drop_duplicates("key" if "key" in frame else name).reset_index(drop=True)
    names = frame[name].to_numpy()
    sets = UnionFind(len(frame))
    shingles = [np.frombuffer(s, dtype="<u8") for s in frame["shingles"]] if with_sets else None
    if with_sets:
        sizes = np.array([len(s) for s in shingles], dtype=np.int64)
        bits = signature_bits(int(sizes.max()), len(sizes))
        signatures = np.empty((len(sizes), bits // 64), dtype=_U)
        for i, s in enumerate(shingles):
            signatures[i] = signature(s, bits)

        def verify(u: int, v: int) -> bool:
            both = len(np.intersect1d(shingles[u], shingles[v], assume_unique=True))
            return both * q >= p * (len(shingles[u]) + len(shingles[v]) - both)

    else:
        sizes = frame["n"].to_numpy().astype(np.int64)
        signatures, verify = folded(list(frame["sig"])), None
    lo, hi = frame["lo"].iloc[0], frame["hi"].iloc[0]
    sides = [np.arange(len(frame))] if lo == hi else [np.flatnonzero(frame["own"] == x) for x in (lo, hi)]
    if all(len(s) for s in sides):
        trees = [Tree(sizes[s], signatures[s]) for s in sides]
        join_trees(trees[0], trees[-1], sets, sides[0], sides[-1], p, q, verify)
        del trees
    del signatures
    if len(frame) > FEW:
        hand_back()
    roots = sets.roots()
    member = np.flatnonzero(roots != np.arange(len(frame)))
    return pd.DataFrame({"a": names[roots[member]], "b": names[member]})


def common_shingles(docs: DataFrame, n: int, n_bytes: int, words: int) -> HashFilter:
    """Shingles that several documents of a sample share; equal texts of the sample count once a task.

    Which ones are found changes the work, never the result.
    """
    share = min(1.0, max(SAMPLE / max(n, 1), 1 / SAMPLE_ONE_IN))
    bits = max(6, int(2 * share * n_bytes // PART_BYTES).bit_length())

    @frees
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[bytes, np.ndarray] = {}
        for batch in batches:
            for _, block in blocks(batch.column(0).to_pylist(), PIECE_BYTES):
                seen.update((_digest(x), x) for x in shingle_sets(block, words))
        if seen:
            every = np.sort(np.concatenate(list(seen.values())))
            cuts = np.searchsorted(every >> _U(64 - bits), np.arange((1 << bits) + 1, dtype=_U))
            own = np.flatnonzero(cuts[:-1] < cuts[1:])
            packed = [every[cuts[i] : cuts[i + 1]].astype("<u8").tobytes() for i in own.tolist()]
            yield pa.RecordBatch.from_arrays([pa.array(own, pa.int32()), pa.array(packed, pa.binary())], names=["part", "packed"])

    def count(group: pd.DataFrame) -> pd.DataFrame:
        every = np.concatenate([np.frombuffer(x, dtype="<u8") for x in group["packed"]])
        own, n_docs = np.unique(every, return_counts=True)
        return pd.DataFrame({"shingle": own[n_docs >= COMMON_LEAST].view("<i8")})

    place = F.pmod(F.xxhash64("doc_id", F.lit("common")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = docs.filter(F.col("doc_id").isNotNull() & (place < share)).select("text")
    parts = sample.mapInArrow(run, "part int, packed binary").groupBy("part").applyInPandas(count, "shingle long")
    found = spool(parts, "common")
    return hash_filter(found, "shingle", 4 * found.count())


def near_duplicates(
    docs: DataFrame, words: int = WORDS, numerator: int = NUMERATOR, denominator: int = DENOMINATOR
) -> DataFrame:
    """(doc_id, n_shingles, component_id) per row, and the row's ``text_key`` (xxhash64 of its text)."""
    spark = docs.sparkSession
    prepare_workers(spark)
    p, q = numerator, denominator
    n_rows, n_bytes = docs.agg(F.count(F.lit(1)), F.sum(F.octet_length("text"))).first()
    parts = max(32, n_rows // 65536, (n_bytes or 0) // PART_BYTES)
    common = spark.sparkContext.broadcast(common_shingles(docs, n_rows, n_bytes or 0, words))

    @frees
    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = Classes(p, q)
        keys, owners, ids, kinds, seen, n_keys = [], [], [], [], set(), 0

        def post() -> Iterator[pa.RecordBatch]:
            if keys:
                yield from _post(
                    np.concatenate(keys), np.concatenate(owners),
                    np.array(ids, dtype=np.int64), np.array(kinds, dtype=np.uint8), parts,
                )

        for batch in batches:
            doc_ids, texts, text_keys = (c.to_pylist() for c in batch.columns)
            for first, run in blocks(texts, PIECE_BYTES):
                rows = {k: [] for k in ("doc_id", "n", "id", "digest", "sig", "text_key", "low", "high")}
                for i, shingles in enumerate(shingle_sets(run, words)):
                    doc_id, n = doc_ids[first + i], len(shingles)
                    digest = _digest(shingles) if n else None
                    own = int.from_bytes(digest[:8], "little", signed=True) if n else None
                    rows["doc_id"].append(doc_id)
                    rows["n"].append(n)
                    rows["text_key"].append(text_keys[first + i])
                    rows["id"].append(own)
                    rows["digest"].append(digest)
                    in_classes = classes.posted_in(n) if n else (None,)
                    rows["low"].append(in_classes[0])
                    rows["high"].append(in_classes[-1])
                    bits = class_bits(classes.bounds(in_classes[-1])[1]) if n else 0
                    rows["sig"].append(signature(shingles, bits).tobytes() if n else None)
                    if n and doc_id is not None and own not in seen:
                        for c, found in classes.keys_by_class(shingles, common.value):
                            keys.append(found)
                            owners.append(np.full(len(found), len(ids), dtype=np.int64))
                            ids.append(own ^ (c << CLASS_SHIFT))
                            kinds.append(c)
                            n_keys += len(found)
                        seen.add(own)
                yield _batch(**rows)
                if n_keys >= POST_KEYS or len(ids) >= POST_SETS or len(seen) >= POST_SETS:
                    yield from post()
                    keys, owners, ids, kinds, seen, n_keys = [], [], [], [], set(), 0
        yield from post()

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    keyed = source.withColumn("text_key", F.xxhash64("text"))
    facts = spool(keyed.mapInArrow(gather, _FACTS_SQL), "shingle-facts")
    rows = facts.filter(F.col("n").isNotNull()).select("doc_id", "n", "id", "digest", "sig", "text_key", "low", "high")
    near = facts.filter(F.col("a").isNotNull()).select("a", "b")
    posted = facts.filter(F.col("part").isNotNull()).select("part", "keys", "places", "ids", "classes")
    met = posted.groupBy("part").applyInPandas(_meet, "a long, b long")
    wide = components(near.unionByName(met), "wide")

    # One member per distinct set; ``rep`` is the smallest document that has it.
    sets = (
        rows.filter(F.col("doc_id").isNotNull() & F.col("id").isNotNull())
        .groupBy("digest")
        .agg(F.min("doc_id").alias("rep"), *(F.first(c).alias(c) for c in ("id", "n", "sig", "low", "high")))
    )
    in_groups = wide.select("node", F.col("root").alias("grp"))
    in_classes = sets.withColumn("class", F.explode(F.sequence("low", "high")))
    nodes = in_classes.withColumn("node", F.col("id").bitwiseXOR(F.shiftleft("class", CLASS_SHIFT)))
    members = spool(nodes.join(in_groups, "node").select("grp", "id", "n", "sig"), "members")
    blocked, tasks = _blocked(members, "grp", "id", F.length("sig") + 24, SPLIT, SIGNATURE_BYTES)
    by_signature = (
        blocked.repartition(tasks, "grp", "lo", "hi")  # few bytes, much work: not to be put together again
        .groupBy("grp", "lo", "hi")
        .applyInPandas(lambda f: _forest(f, "id", p, q, False), "a long, b long")
    )
    narrow = components(by_signature, "narrow")
    chosen = spool(
        sets.select("digest", "id", "rep", "n").join(
            narrow.select(F.col("node").alias("id"), F.col("root").alias("grp")), "id"
        ),
        "chosen",
    )
    wanted = spark.sparkContext.broadcast(hash_filter(chosen, "rep", chosen.count()))

    @frees
    def read_again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc_ids = batch.column(0).to_numpy()
            picked = batch.filter(pa.array(wanted.value.holds(doc_ids.view(_U))))
            doc_ids, texts = picked.column(0).to_pylist(), picked.column(1).to_pylist()
            for first, run in blocks(texts, PIECE_BYTES):
                found = shingle_sets(run, words)
                yield pa.RecordBatch.from_pydict(
                    {
                        "rep": pa.array(doc_ids[first : first + len(run)], pa.int64()),
                        "digest": pa.array([_digest(s) if len(s) else None for s in found], pa.binary()),
                        "shingles": pa.array([s.astype("<u8").tobytes() for s in found], pa.binary()),
                    }
                )

    again = source.filter(F.col("doc_id").isNotNull()).mapInArrow(
        read_again, "rep long, digest binary, shingles binary"
    )
    blocked, tasks = _blocked(chosen.select("grp", "rep", "digest", "n"), "grp", "digest", 8 * F.col("n") + 40)
    verified = (
        blocked.join(again, ["rep", "digest"])
        .select("grp", "lo", "hi", "own", "rep", F.col("digest").alias("key"), "shingles")
        .repartition(tasks, "grp", "lo", "hi")
        .groupBy("grp", "lo", "hi")
        .applyInPandas(lambda f: _forest(f, "rep", p, q, True), "a long, b long")
    )
    linked = components(verified, "linked")
    labelled = sets.select("digest", "rep").join(
        linked.select(F.col("node").alias("rep"), F.col("root").alias("root")), "rep", "left"
    )
    named = labelled.select("digest", F.coalesce("root", "rep").alias("class"))
    return rows.join(named, "digest", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("class", "doc_id")).alias("component_id"),
        "text_key",
    )


def query(spark, sf_dir: str) -> DataFrame:
    """op10: groups of all documents at nine tenths of three-word shingles."""
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")
