"""Benchmark decontamination by template canonicalisation.

A text becomes a sequence of codes: numbers, units after numbers and names (capitalised inside a sentence) turn into
typed placeholders, other words are hashed in lower case. Windows of WINDOW codes are hashed on both sides and
joined; the values behind the placeholders (slots) go along. A question that was re-parameterised has other
numbers or names, but the same template. A capitalised word that opens a sentence may be a name or not: windows that
hold one are hashed in both forms, and either form may match.

A match between a document and an item is read along alignments (one difference of positions each). In an alignment an
item value that meets two document values is in conflict, and windows that hold it in a slot do not count unless they are
verbatim. Windows matched by a name that opens a sentence never put others in conflict. Windows left that cover at least
COVERAGE of an item's windows make the document contaminated by that item, and so do RUN consecutive words of the item
held verbatim, whatever share of the item they are.

Documents send only windows that pass a bit filter over the benchmark's window hashes (fixed size, no window is lost),
so texts are read once and never shuffled; the exact join follows. Every window is also hashed with its slot values, so
that it matches verbatim. Windows that are placeholders for the most part (fewer than LEAST_WORDS words) say nothing as
templates and match in that form only. An item's coverage is the larger of two shares: of all its windows, and of its
windows that are templates.

Defined cases: null or empty texts, and texts without words, match nothing; rows without an id match nothing; rows that
share a doc_id count as one document, items that share an item_id as one item; an item shorter than a window is one window
of its own length; empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.llm.common import (
    LOWER,
    _BYTE_CODES,
    _powers_up_to,
    blocks,
    frees,
    hash_filter,
    mix,
    pieces,
    prepare_workers,
    spool,
    table,
)

WINDOW = 8
LEAST_WORDS = 3
COVERAGE = 0.5
#: Consecutive words held verbatim that are enough, however long the item is.
RUN = 13
BLOCK = 1 << 20
#: Forms of a window: with its values; words that open a sentence are words, or names.
EXACT, PLAIN, OPENED = 0, 1, 2

#: Units, in lower case; only right after a number.
UNITS = (
    "mm cm m km in inch inches ft foot feet yd yard yards mile miles mg g kg t lb lbs oz ounce ounces gram grams "
    "kilogram kilograms ton tons ml l liter liters litre litres gallon gallons cup cups ms s sec second seconds min "
    "minute minutes h hr hour hours day days week weeks month months year years mph kmh hz khz mhz ghz w kw v a "
    "j kj cal kcal pa kpa bar percent dollar dollars cent cents euro euros pound pounds degree degrees"
).split()
NUMBER, UNIT, NAME = (np.uint64(x) for x in mix(np.arange(3, dtype=np.uint64), 1234))

_U = np.uint64
_SEP, _LETTER, _DIGIT = 0, 1, 2
_KIND = np.zeros(256, dtype=np.uint8)
_KIND[[*range(65, 91), *range(97, 123), *range(128, 256)]] = _LETTER
_KIND[48:58] = _DIGIT
_STOP = np.zeros(256, dtype=bool)
_STOP[[ord(c) for c in ".!?:;\n"]] = True


def _lowered(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes in lower case (ASCII, Latin-1, basic Cyrillic), and where a capital letter begins."""
    low, before = LOWER[data], np.concatenate((np.zeros(1, dtype=np.uint8), data[:-1]))
    latin = (before == 0xC3) & (data >= 0x80) & (data <= 0x9E) & (data != 0x97)
    first_rows = (before == 0xD0) & (data >= 0x90) & (data <= 0x9F)
    last_rows = (before == 0xD0) & (data >= 0xA0) & (data <= 0xAF)
    low = np.where(latin | first_rows, data + np.uint8(0x20), low)
    low = np.where(last_rows, data - np.uint8(0x20), low)
    lead = np.concatenate((last_rows[1:], [False]))
    low[lead] = 0xD1
    capital = (data >= 65) & (data <= 90)
    capital[:-1] |= (latin | first_rows | last_rows)[1:]
    return low, capital


def _tokens(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(code, slot value, opening value, start) of every token.

    The slot value is 0 where the code is a word; the opening value is 0 but for words that may be names and open a sentence.
    """
    low, capital = _lowered(data)
    kind = _KIND[data]
    edge = np.flatnonzero(np.diff(kind)) + 1
    edge = np.concatenate(([0], edge, [len(data)]))
    start, end = edge[:-1], edge[1:]
    solid = kind[start] != _SEP
    start, end = start[solid], end[solid]
    if not len(start):
        return np.zeros(0, dtype=_U), np.zeros(0, dtype=_U), np.zeros(0, dtype=_U), start
    power, inverse = _powers_up_to(len(data))
    with np.errstate(over="ignore"):
        total = np.concatenate((np.zeros(1, dtype=_U), np.cumsum(_BYTE_CODES[low] * power[: len(data)], dtype=_U)))
        value = mix((total[end] - total[start]) * inverse[start], 6)
    digit = kind[start] == _DIGIT
    # 1,000 and 2.5 are one number each.
    joins = np.zeros(len(start), dtype=bool)
    joins[1:] = digit[1:] & digit[:-1] & (start[1:] == end[:-1] + 1) & np.isin(data[end[:-1]], (44, 46))
    head = np.flatnonzero(~joins)
    with np.errstate(over="ignore"):
        place = np.arange(len(start)) - np.repeat(head, np.diff(np.concatenate((head, [len(start)]))))
        value = np.add.reduceat(mix(value + place.astype(_U), 7), head)
    last = np.concatenate((head[1:], [len(start)])) - 1
    start, end, digit = start[head], end[last], digit[head]
    stops = np.concatenate(([0], np.cumsum(_STOP[data])))
    begins = np.ones(len(start), dtype=bool)
    begins[1:] = stops[start[1:]] > stops[end[:-1]]
    next_capital = capital[np.minimum(start + np.where(data[start] >= 128, 2, 1), len(data) - 1)]
    capitalised = ~digit & capital[start] & ~next_capital & (end - start >= 2)
    name = capitalised & ~begins
    unit = np.zeros(len(start), dtype=bool)
    unit[1:] = ~digit[1:] & digit[:-1] & np.isin(value[1:], _unit_values())
    code = np.where(digit, NUMBER, np.where(unit, UNIT, np.where(name, NAME, value)))
    slot = np.where(digit | unit | name, value | _U(1), _U(0))
    opening = np.where(capitalised & begins & ~unit, value | _U(1), _U(0))
    return code, slot, opening, start


_units: list[np.ndarray] = []


def _unit_values() -> np.ndarray:
    if not _units:
        _units.append(np.zeros(0, dtype=_U))
        values = [_tokens(np.frombuffer(u.encode(), dtype=np.uint8))[0][0] for u in UNITS]
        _units[0] = np.array(values, dtype=_U)
    return _units[0]


def sequences(run: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(code, slot value, opening value, text) of the tokens of several texts."""
    data = np.frombuffer(b"\n".join(run) + b"\n", dtype=np.uint8)
    ends = np.cumsum([len(d) + 1 for d in run])
    codes, slots, openings, starts = [], [], [], []
    for a, b in pieces(data):
        code, slot, opening, start = _tokens(data[a:b])
        codes.append(code)
        slots.append(slot)
        openings.append(opening)
        starts.append(start + a)
    starts = np.concatenate(starts)
    text = np.searchsorted(ends, starts, side="right")
    return np.concatenate(codes), np.concatenate(slots), np.concatenate(openings), text


def spans(text: np.ndarray, size: int, whole: bool) -> np.ndarray:
    """First tokens of the windows of ``size`` tokens inside one text; ``whole``: only texts of just that size."""
    n = len(text) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64)
    inside = text[:n] == text[size - 1 :]
    if whole:
        inside &= np.concatenate(([True], text[1:n] != text[: n - 1]))
        inside &= np.concatenate((text[size:] != text[: n - 1], [True]))
    return np.flatnonzero(inside)


def among(marks: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """How many of the tokens of each window are marked."""
    total = np.concatenate(([0], np.cumsum(marks)))
    return total[at + size] - total[at]


def hashes(code: np.ndarray, at: np.ndarray, size: int, salt: int) -> np.ndarray:
    acc = np.full(len(at), size, dtype=_U)
    with np.errstate(over="ignore"):
        for k in range(size):
            acc = acc * _U(0x9E3779B97F4A7C55) + code[at + k]
    return mix(acc, salt)


def forms(run: list[bytes], sizes: dict[int, bool]) -> Iterator[tuple[int, int, *tuple[np.ndarray, ...]]]:
    """(form, size, hash, first token, whether it is a template, slots of all tokens, their text, first token of each text)."""
    code, slot, opening, text = sequences(run)
    origin = np.searchsorted(text, np.arange(len(run)))
    opens = opening != 0
    open_code, open_slot = np.where(opens, NAME, code), np.where(opens, opening, slot)
    exact, none = np.where(slot != 0, slot, code | _U(1)), np.zeros(len(code), dtype=_U)
    for size, whole in sizes.items():
        at, least = spans(text, size, whole), min(LEAST_WORDS, size)
        words = among(slot == 0, at, size)
        yield EXACT, size, hashes(exact, at, size, 9), at, words >= least, none, text, origin
        # Without slots the exact form says it all.
        plain = at[(words >= least) & (words < size)]
        yield PLAIN, size, hashes(code, plain, size, 8), plain, np.ones(len(plain), dtype=bool), slot, text, origin
        opened = at[(among(opens, at, size) > 0) & (among(open_slot == 0, at, size) >= least)]
        yield OPENED, size, hashes(open_code, opened, size, 8), opened, np.ones(len(opened), dtype=bool), open_slot, text, origin


def _match_rows(ids, texts, sizes: dict[int, bool], keep=None) -> Iterator[pa.RecordBatch]:
    """Rows of SCHEMA: windows of the given sizes, in every form, that ``keep`` lets through."""
    for first, run in blocks(texts, BLOCK):
        columns = [[], [], [], [], [], []]
        for form, size, h, at, template, slot, text, origin in forms(run, sizes):
            if keep is not None:
                passed = keep.holds(h)
                h, at, template = h[passed], at[passed], template[passed]
            columns[0] += [ids[first + t] for t in text[at].tolist()]
            columns[1] += (at - origin[text[at]]).tolist()
            columns[2] += h.view(np.int64).tolist()
            columns[3] += [form] * len(at)
            columns[4] += template.tolist()
            columns[5] += [s[s != 0].view(np.int64).tolist() for s in (slot[i : i + size] for i in at.tolist())]
        if columns[0]:
            types = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)], names=["id", "pos", "h", "form", "template", "slots"]
            )


SCHEMA = "id long, pos long, h long, form int, template boolean, slots array<long>"


def item_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Windows of all items; an item below the window size is one window of its own."""
    sizes = {window: False} | {n: True for n in range(1, window)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _match_rows(batch.column(0).to_pylist(), batch.column(1).to_pylist(), sizes)

    prepare_workers(benchmark.sparkSession)
    rows = benchmark.filter(F.col("item_id").isNotNull()).select(F.col("item_id").cast("long").alias("id"), "text")
    return rows.mapInArrow(run, SCHEMA)


def short_sizes(benchmark: DataFrame, window: int = WINDOW) -> dict[int, bool]:
    """Window sizes to look for in documents: ``window``, and the sizes of shorter items."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = set()
        for batch in batches:
            for _, block in blocks(batch.column(0).to_pylist(), BLOCK):
                found |= set(np.bincount(sequences(block)[3], minlength=1).tolist())
        yield pa.RecordBatch.from_pydict({"n": pa.array(sorted(x for x in found if 0 < x < window), pa.int64())})

    got = benchmark.select("text").mapInArrow(run, "n long").distinct().collect()  # fewer than ``window`` numbers
    return {window: False} | {r["n"]: False for r in got}


def item_sizes(benchmark: DataFrame) -> DataFrame:
    """(item_id, item_tokens): the tokens of each item, the most of its rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, sizes = batch.column(0), []
            for _, block in blocks(batch.column(1).to_pylist(), BLOCK):
                sizes += np.bincount(sequences(block)[3], minlength=len(block)).tolist()
            yield pa.RecordBatch.from_arrays([ids, pa.array(sizes, pa.int64())], names=["item_id", "item_tokens"])

    prepare_workers(benchmark.sparkSession)
    rows = benchmark.filter(F.col("item_id").isNotNull()).select(F.col("item_id").cast("long").alias("item_id"), "text")
    return rows.mapInArrow(run, "item_id long, item_tokens long").groupBy("item_id").agg(F.max("item_tokens").alias("item_tokens"))


def contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, coverage: float = COVERAGE) -> DataFrame:
    """(doc_id, item_id, matched, n_windows, coverage, verbatim, item_tokens) of documents with an item or its variant.

    ``item_tokens`` tells how much text stands behind a row: an item shorter than a window is found wherever its few
    tokens occur, which by itself may say little.
    """
    spark = docs.sparkSession
    prepare_workers(spark)
    items = spool(item_windows(benchmark, window), "item-windows")
    sizes = short_sizes(benchmark, window)
    seen = spark.sparkContext.broadcast(hash_filter(items, "h", items.count()))

    @frees
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _match_rows(batch.column(0).to_pylist(), batch.column(1).to_pylist(), sizes, seen.value)

    found = (
        docs.filter(F.col("doc_id").isNotNull())
        .select(F.col("doc_id").cast("long").alias("id"), "text")
        .mapInArrow(run, SCHEMA)
        .select(
            F.col("id").alias("doc_id"),
            F.col("pos").alias("doc_pos"),
            "h",
            F.col("form").alias("doc_form"),
            F.col("slots").alias("doc_slots"),
        )
    )
    sides = items.select(
        F.col("id").alias("item_id"),
        F.col("pos").alias("item_pos"),
        "h",
        F.col("form").alias("item_form"),
        "template",
        F.col("slots").alias("item_slots"),
    )
    per_item = sides.groupBy("item_id").agg(
        F.countDistinct("item_pos").alias("n_windows"),
        F.countDistinct(F.when(F.col("template"), F.col("item_pos"))).alias("n_templates"),
    )
    form = F.greatest("item_form", "doc_form").alias("form")
    pairs = F.arrays_zip("item_slots", "doc_slots").alias("met")
    row = F.struct(form, F.col("item_pos").alias("place"), "template", pairs)
    aligned = (
        found.join(sides, "h")
        .groupBy("doc_id", "item_id", (F.col("doc_pos") - F.col("item_pos")).alias("shift"))
        .agg(F.collect_set(row).alias("rows"))
    )

    # Windows matched in their plain form are held against each other, opened ones against all.
    def met(most: int):
        return F.array_sort(F.array_distinct(F.flatten(F.transform(F.filter("rows", lambda r: r["form"] <= most), lambda r: r["met"]))))

    def conflicts(name: str):
        """Item values with two document values: equal neighbours in the sorted pairs."""
        later = F.slice(name, 2, F.greatest(F.size(name) - 1, F.lit(0)))
        beside = F.filter(F.arrays_zip(later.alias("b"), F.col(name).alias("a")), lambda p: p["b"]["item_slots"] == p["a"]["item_slots"])
        return F.array_distinct(F.transform(beside, lambda p: p["a"]["item_slots"]))

    def agrees(name: str):
        return ~F.arrays_overlap(F.transform("row.met", lambda m: m["item_slots"]), F.col(name))

    # Windows in a row that make RUN words; an item below the window size has one window and is matched whole.
    row_of = max(RUN - window + 1, 1)
    exact = F.array_sort(F.array_distinct(F.transform(F.filter("rows", lambda r: r["form"] == EXACT), lambda r: r["place"])))
    ends = F.slice("exact", row_of, F.greatest(F.size("exact") - row_of + 1, F.lit(0)))
    run_long = F.exists(F.arrays_zip(ends.alias("last"), F.col("exact").alias("first")), lambda p: p["last"] - p["first"] == row_of - 1)
    matched = (
        aligned.withColumns({"met_plain": met(PLAIN), "met_any": met(OPENED), "exact": exact})
        .withColumn("run", F.coalesce(run_long, F.lit(False)))
        .withColumns({"plain": conflicts("met_plain"), "any": conflicts("met_any")})
        .select("doc_id", "item_id", "run", "plain", "any", F.explode("rows").alias("row"))
        .filter((F.col("row.form") == EXACT) | F.when(F.col("row.form") == PLAIN, agrees("plain")).otherwise(agrees("any")))
        .select(
            "doc_id",
            "item_id",
            "run",
            F.col("row.place").alias("place"),
            F.col("row.template").alias("template"),
            F.forall("row.met", lambda m: m["item_slots"] == m["doc_slots"]).alias("same"),
        )
        .groupBy("doc_id", "item_id")
        .agg(
            F.max("run").alias("run"),
            F.countDistinct("place").alias("matched"),
            F.countDistinct(F.when(F.col("template"), F.col("place"))).alias("n_matched_templates"),
            F.countDistinct(F.when(F.col("same"), F.col("place"))).alias("n_same"),
        )
        .withColumn("verbatim", F.col("n_same") == F.col("matched"))
    )
    of_all = F.col("matched") / F.col("n_windows")
    of_templates = F.when(F.col("n_templates") > 0, F.col("n_matched_templates") / F.col("n_templates"))
    share = F.greatest(of_all, of_templates)
    return (
        matched.join(per_item, "item_id")
        .filter((share >= coverage) | F.col("run"))
        .join(item_sizes(benchmark), "item_id")
        .select("doc_id", "item_id", "matched", "n_windows", share.alias("coverage"), "verbatim", "item_tokens")
    )


def query(spark, sf_dir: str) -> DataFrame:
    """op8: all documents that hold a benchmark item, verbatim or with other numbers and names."""
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
