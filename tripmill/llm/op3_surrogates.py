"""Personal data replaced by keyed surrogates of the same type and format.

Detected entities (addresses, numbers, keys, secrets, names of people) get surrogates that depend on a key and the entity
alone, so the same entity has the same surrogate in every document (coreference). Format-preserving permutations
(a Feistel network over the entity's characters, walked until type rules hold: Luhn and IBAN checks, area codes, valid
octets) keep different entities of a format apart. Given names are rotated within their script and gender, family
names are built from syllables of their script.

Collisions are checked over the whole corpus: distinct entities (not texts) are shuffled, a surrogate that two entities
share or that is itself an entity of the corpus moves to the next attempt, until none is left; after LENGTHEN attempts
the surrogates of addresses, secrets, keys and families grow, so a crowded format does not end the job. Families of both
genders move together. Moved entities are few; they are sent along while below MOVED_BOUND, and joined to the documents
that hold them otherwise.

Digits of any script are read as digits and written back in theirs. Letters outside of a-z are replaced by letters of their
own block and case. A secret without a letter or digit is a mask and stays, like placeholders (``<...>``, ``${...}``,
``[...]``) and calls (``...()``).

Defined cases: null texts stay null, texts without entities stay as they are; repeated rows are treated alike; an
empty table gives no rows; all other columns are kept (one of the name ``kinds`` is replaced).
"""

from __future__ import annotations

import hashlib
import re
import sys
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.llm.common import free_name, prepare_workers, spool, table

KEY = b"surrogates-1"
#: Entities that may be sent to every task; beyond, they are joined.
MOVED_BOUND = 100_000
MOST_ATTEMPTS = 40
#: From this attempt on, surrogates without a fixed length grow by a letter every time.
LENGTHEN = 8

# Name lists by script and gender, titles by gender, syllables of family names.
GIVEN = {
    ("latin", "m"): "James John Robert Michael William David Richard Joseph Thomas Charles Daniel Matthew Anthony "
    "Andrew Hans Klaus Jürgen Pierre Jacques François Carlos José Javier Miguel".split(),
    ("latin", "f"): "Mary Patricia Jennifer Linda Elizabeth Barbara Susan Jessica Sarah Karen Nancy Margaret Emily "
    "Rebecca Ursula Ingrid Sabine Marie Claire Hélène Carmen María Lucía Isabel".split(),
    ("cyrillic", "m"): "Иван Алексей Сергей Дмитрий Николай Владимир Андрей Михаил".split(),
    ("cyrillic", "f"): "Анна Мария Ольга Елена Наталья Татьяна Светлана Екатерина".split(),
}
TITLES = {
    "m": "Mr Herr Monsieur Señor Sir".split(),
    "f": "Mrs Ms Miss Frau Madame Mademoiselle Señora Señorita Lady".split(),
    "": "Dr Prof Professor Doctor".split(),
}
SYLLABLES = {
    "latin": "ba be bo da de do fa fe ga go ha he ka ke ko la le lo ma me mo na ne no ra re ro sa se ta te va".split(),
    "cyrillic": "ба бе бо ва ве го да де до за зо ка ко ла ле ло ма ме мо на не но па по ра ре ро са се та то".split(),
}
FAMILY_END = {("latin", ""): "n", ("cyrillic", ""): "нов", ("cyrillic", "f"): "нова"}

_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_HEX = "0123456789abcdef"

_CAPITAL = r"[A-ZÀ-ÖØ-ÞА-Я][\w'’-]+"
_TITLE_WORDS = "|".join(t for ts in TITLES.values() for t in ts)
_GIVEN_WORDS = "|".join(n for ns in GIVEN.values() for n in ns)
_NAME = re.compile(
    rf"\b(?:(?P<title>{_TITLE_WORDS})\.? (?:(?P<given>{_GIVEN_WORDS}) )?(?P<family>{_CAPITAL})"
    rf"|(?P<given2>{_GIVEN_WORDS})\b(?: (?P<family2>{_CAPITAL}))?)"
)
_EMAIL = re.compile(r"(?<![\w.+-])[\w.+-]++@[\w-]+(?:\.[\w-]+)+")
_SECRET = re.compile(
    r"(?i)\b(?:password|passwd|pwd|secret|token|api[_-]?key)\b[\"']?\s*[=:]\s*(?P<quote>[\"']?)(?P<value>[^\s\"']{6,})"
)
_TOKEN = re.compile(r"\b(?P<head>AKIA|ASIA|gh[pousr]_|sk-|xox[bp]-)(?P<body>[A-Za-z0-9_-]{12,})")
_NUMBERS = re.compile(
    r"(?P<iban>\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b)"
    r"|(?P<ip>(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?![\d.]*\d))"
    r"|(?P<ssn>(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-]))"
    r"|(?P<card>(?<![\d+])\d(?:[ -]?\d){12,18}(?!\d))"
    r"|(?P<phone>(?<!\w)\+\d{1,3}[ .-]?\(?\d{1,4}\)?(?:[ .-]?\d{2,4}){2,4}(?!\d)"
    r"|(?<!\w)\(\d{3}\) ?\d{3}[ .-]\d{4}(?!\d)|(?<![\w.-])\d{3}[.-]\d{3}[.-]\d{4}(?![\w-]))"
)
_DIGIT = re.compile(r"\d")
_PLACEHOLDER = re.compile(r"<.*>|\$\{.*\}|\[.*\]|[\w.]+\(\)[;,]?")
#: Digits outside of ASCII, by their value.
_FOLD = {cp: str(unicodedata.digit(chr(cp))) for cp in range(128, sys.maxunicode + 1) if unicodedata.category(chr(cp)) == "Nd"}
#: Texts that may hold one; beyond the first plane any character counts, which keeps the search a table look-up.
_ODD_DIGIT = re.compile("[" + "".join(chr(cp) for cp in _FOLD if cp < 0x10000) + "\U00010000-\U0010ffff]")

Entity = tuple[int, int, str, str]


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _iban(value: str) -> bool:
    return int("".join(str(int(c, 36)) for c in value[4:] + value[:4])) % 97 == 1


def _script(word: str) -> str:
    return "cyrillic" if "А" <= word[0] <= "я" else "latin"


@lru_cache(maxsize=1)
def _gender_of() -> dict[str, tuple[str, str]]:
    return {name: group for group, names in GIVEN.items() for name in names}


def entities(text: str | None) -> list[Entity]:
    """(start, end, type, canonical form) of the entities of a text, without overlaps, in order."""
    if not text:
        return []
    found: list[Entity] = []
    plain_text = text if text.isascii() or not _ODD_DIGIT.search(text) else text.translate(_FOLD)
    if "@" in text:
        found += [(m.start(), m.end(), "email", m[0].lower()) for m in _EMAIL.finditer(text)]
    for m in _SECRET.finditer(text):
        if not any(map(str.isalnum, m["value"])) or _PLACEHOLDER.fullmatch(m["value"]):
            continue
        found.append((m.start("value"), m.end("value"), "secret", m["value"]))
    for m in _TOKEN.finditer(text):
        found.append((m.start(), m.end(), f"key:{m['head']}", m[0]))
    if _DIGIT.search(text):
        for m in _NUMBERS.finditer(plain_text):
            kind = m.lastgroup
            plain = re.sub(r"[^0-9A-Z]", "", m[0])
            if kind == "ip":
                octets = [int(x) for x in m[0].split(".")]
                if max(octets) > 255:
                    continue
                plain = ".".join(map(str, octets))
            elif kind == "iban" and not _iban(plain):
                continue
            elif kind == "phone":
                country = re.match(r"\+(\d{1,3})[ .(-]", m[0])
                plain = f"+{country[1]} {plain[len(country[1]):]}" if country else f"+ {plain}"
            found.append((m.start(), m.end(), kind, plain))
    for m in _NAME.finditer(text):
        genders = _gender_of()
        given, family = m["given"] or m["given2"], m["family"] or m["family2"]
        group = "given" if given else "family"
        if family in genders and not given:  # "Mr James": a given name after a title
            given, group, family = family, "family", None
        if given:
            script, gender = genders[given]
            at = m.start("given") if m["given"] else m.start("given2") if m["given2"] else m.start(group)
            found.append((at, at + len(given), f"given:{script}:{gender}", given))
        if family:
            gender = next((g for g, ts in TITLES.items() if m["title"] in ts), "") or (
                genders[given][1] if given else ""
            )
            at = m.start("family") if m["family"] else m.start("family2")
            script = _script(family)
            stem = family.removesuffix("а") if script == "cyrillic" and gender == "f" else family
            found.append((at, at + len(family), f"family:{script}:{gender if script == 'cyrillic' else ''}", stem.title()))
    kept: list[Entity] = []
    for e in sorted(found, key=lambda e: (e[0], -e[1])):
        if not kept or e[0] >= kept[-1][1]:
            kept.append(e)
    return kept


def _hash(key: bytes, *parts: object) -> int:
    data = "\x1f".join(map(str, parts)).encode()
    return int.from_bytes(hashlib.blake2b(data, key=key[:64], digest_size=32).digest(), "big")


def permute(value: int, size: int, key: bytes, tweak: str) -> int:
    """A keyed bijection on [0, size): Feistel rounds on two halves, walked until the result is inside."""
    if size <= 1:
        return value
    half = ((size - 1).bit_length() + 1) // 2
    mask = (1 << half) - 1
    while True:
        left, right = value >> half, value & mask
        for i in range(8):
            left, right = right, left ^ (_hash(key, tweak, size, i, right) & mask)
        value = left << half | right
        if value < size:
            return value


@lru_cache(maxsize=4096)
def _alphabet(c: str) -> str:
    """Digits, small or capital letters; outside of ASCII the letters and digits of the same kind among 32 neighbours."""
    kind, first = unicodedata.category(c), ord(c) & ~31
    if c.isascii() or kind[0] not in "LN":
        return next((a for a in (_DIGITS, _LOWER, _UPPER) if c in a), c)
    return "".join(x for x in map(chr, range(max(first, 128), first + 32)) if unicodedata.category(x) == kind)


def _alphabets(text: str) -> list[str]:
    """The characters each place may hold; a single one where a place stays as it is."""
    if re.fullmatch(r"[0-9a-f]{8,}", text) and re.search(r"[a-f]", text):
        return [_HEX] * len(text)
    return [_alphabet(c) for c in text]


def settled_as(kind: str) -> str:
    """The type under which an entity's attempts are counted: one for the families of both genders of a script."""
    return ":".join(kind.split(":")[:2]) if kind.startswith("family:") else kind


def _longer(made: str, key: bytes, tweak: str, canon: str, attempt: int) -> str:
    """Letters that follow the surrogate from attempt LENGTHEN on."""
    h, out = _hash(key, "longer", tweak, canon), made
    for _ in range(attempt - LENGTHEN + 1):
        h, place = divmod(h, len(_LOWER))
        out += _LOWER[place]
    return out


def scramble(text: str, key: bytes, tweak: str, alphabets: list[str] | None = None, fits=None) -> str:
    """The text with every place permuted within its alphabet; walked until ``fits``."""
    alphabets = alphabets or _alphabets(text)
    size, value = 1, 0
    for c, a in zip(text, alphabets):
        size, value = size * len(a), value * len(a) + a.index(c)
    shape = "".join("." if len(a) == 1 else chr(64 + len(a)) for a in alphabets)
    while True:
        value = permute(value, size, key, f"{tweak}|{shape}")
        rest, out = value, []
        for a in reversed(alphabets):
            rest, place = divmod(rest, len(a))
            out.append(a[place])
        made = "".join(reversed(out))
        if fits is None or fits(made):
            return made


@lru_cache(maxsize=1 << 16)
def surrogate(kind: str, canon: str, key: bytes = KEY, attempt: int = 0) -> str:
    """The canonical surrogate of a canonical entity."""
    tweak = f"{kind}|{attempt}"
    if kind == "email":
        head, _, top = canon.rpartition(".")
        return f"{_longer(scramble(head, key, tweak), key, tweak, canon, attempt)}.{top}"
    if kind == "ip":
        value = int.from_bytes(bytes(map(int, canon.split("."))), "big")
        while True:
            value = permute(value, 1 << 32, key, tweak)
            if 0 < value >> 24 < 224 and 0 < value & 255 < 255:
                return ".".join(map(str, value.to_bytes(4, "big")))
    if kind == "phone":
        country, _, rest = canon.partition(" ")
        high = rest[:1] >= "2"
        return f"{country} {scramble(rest, key, tweak + country, fits=lambda x: (x[:1] >= '2') == high)}"
    if kind == "card":
        valid = _luhn(canon)
        return canon[0] + scramble(canon[1:], key, tweak + canon[0], fits=lambda x: _luhn(canon[0] + x) == valid)
    if kind == "ssn":
        usual = canon[:3] not in ("000", "666") and canon[0] != "9"
        return scramble(canon, key, tweak, fits=lambda x: (x[:3] not in ("000", "666") and x[0] != "9") == usual)
    if kind == "iban":
        return canon[:2] + scramble(canon[2:], key, tweak + canon[:2], fits=lambda x: _iban(canon[:2] + x))
    if kind.startswith("key:"):
        head, body = kind[4:], canon[len(kind) - 4 :]
        whole = _UPPER + _DIGITS if body == body.upper() else _UPPER + _LOWER + _DIGITS
        made = scramble(body, key, tweak, [whole if c in whole else c for c in body])
        return head + _longer(made, key, tweak, canon, attempt)
    if kind.startswith("given:"):
        _, script, gender = kind.split(":")
        order = sorted(GIVEN[script, gender], key=lambda n: _hash(key, kind, n))
        return order[(order.index(canon) + 1) % len(order)]
    if kind.startswith("family:"):
        _, script, *rest = kind.split(":")
        gender = rest[0] if rest else ""
        syllables, h = SYLLABLES[script], _hash(key, f"family:{script}|{attempt}", canon)
        made = ""
        for _ in range(3 + attempt // 2):
            h, place = divmod(h, len(syllables))
            made += syllables[place]
        return (made + FAMILY_END.get((script, gender), FAMILY_END[script, ""])).title()
    return _longer(scramble(canon, key, tweak), key, tweak, canon, attempt)  # secrets


def _as_digit(digit: str, place: str) -> str:
    """The digit in the script of the one whose place it takes."""
    return chr(ord(place) - int(_FOLD[ord(place)]) + int(digit)) if ord(place) in _FOLD else digit


def fit_format(kind: str, original: str, made: str) -> str:
    """The canonical surrogate in the layout and case of the place it goes to."""
    if kind in ("card", "ssn", "phone", "iban"):
        flat = iter(re.sub(r"[^0-9A-Z]", "", made))
        return "".join(_as_digit(next(flat), c) if c.isascii() and c.isalnum() or ord(c) in _FOLD else c for c in original)
    if kind == "ip":
        return "".join(_as_digit(c, original[0]) if c.isdigit() else c for c in made)
    if kind == "email" and len(made) == len(original):
        return "".join(m.upper() if o.isupper() and len(m.upper()) == 1 else m for o, m in zip(original, made))
    if kind.startswith("family:") and original.isupper() and len(original) > 1:
        return made.upper()
    return made


def replace(text: str | None, key: bytes = KEY, moved: dict[tuple[str, str], int] | None = None) -> tuple[str | None, list[str]]:
    """The text with surrogates, and the types of what was replaced."""
    out, last, kinds = [], 0, []
    for start, end, kind, canon in entities(text):
        made = surrogate(kind, canon, key, (moved or {}).get((settled_as(kind), canon), 0))
        out += [text[last:start], fit_format(kind, text[start:end], made)]
        last = end
        kinds.append(kind.partition(":")[0])
    return ("".join([*out, text[last:]]) if kinds else text), kinds


def corpus_entities(docs: DataFrame, key: bytes = KEY, text: str = "text") -> DataFrame:
    """(kind, canon, attempt, made): distinct entities with their first surrogates."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = {(settled_as(e[2]), e[3]) for t in batch.column(0).to_pylist() for e in entities(t)}
            if own:
                kinds, canons = zip(*own)
                made = [surrogate(k, c, key) for k, c in own]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(kinds), pa.array(canons), pa.array([0] * len(own), pa.int32()), pa.array(made)],
                    names=["kind", "canon", "attempt", "made"],
                )

    prepare_workers(docs.sparkSession)
    return docs.select(F.col(text)).mapInArrow(run, "kind string, canon string, attempt int, made string").distinct()


def settle(found: DataFrame, key: bytes = KEY) -> DataFrame:
    """(kind, canon, attempt) of the entities that had to leave their first surrogate."""
    # Given names are rotated within their list: they cannot collide, and are entities of the corpus themselves.
    current = found.filter(~F.col("kind").startswith("given:"))
    originals = current.select("kind", F.col("canon").alias("made")).distinct()

    def again(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch["attempt"] += 1
            batch["made"] = [surrogate(k, c, key, a) for k, c, a in zip(batch["kind"], batch["canon"], batch["attempt"])]
            yield batch

    for _ in range(MOST_ATTEMPTS):
        shared = current.groupBy("kind", "made").agg(F.count(F.lit(1)).alias("n"), F.min("canon").alias("keeps"))
        taken = shared.join(originals.withColumn("real", F.lit(True)), ["kind", "made"], "left").filter(
            (F.col("n") > 1) | F.col("real")
        )
        marked = current.join(taken, ["kind", "made"], "left").withColumn(
            "moves", F.col("n").isNotNull() & (F.col("real").isNotNull() | (F.col("canon") != F.col("keeps")))
        )
        marked = spool(marked.select("kind", "canon", "attempt", "made", "moves"), "surrogates")
        moving = marked.filter("moves").drop("moves")
        if moving.isEmpty():
            return marked.filter(F.col("attempt") > 0).select("kind", "canon", "attempt")
        moving = moving.mapInPandas(again, "kind string, canon string, attempt int, made string")
        current = marked.filter(~F.col("moves")).drop("moves").unionByName(moving)
    raise RuntimeError(f"surrogates still collide after {MOST_ATTEMPTS} attempts")


def with_surrogates(
    docs: DataFrame, key: bytes = KEY, moved_bound: int = MOVED_BOUND, text: str = "text", kinds: str = "surrogate_kinds"
) -> DataFrame:
    """``docs`` with the text column replaced, and a column ``kinds`` (the types replaced, in order) added."""
    spark = docs.sparkSession
    found = spool(corpus_entities(docs, key, text), "entities")
    moved = spool(settle(found, key), "moved")
    n = moved.count()
    schema = "text string, kinds array<string>"
    slot, place, own = (free_name(docs, x) for x in ("_made", "_place", "_moved"))
    if n <= moved_bound:
        at = {(r["kind"], r["canon"]): r["attempt"] for r in moved.collect()}
        sent = spark.sparkContext.broadcast(at)

        @F.pandas_udf(schema)
        def apply(texts: pd.Series) -> pd.DataFrame:
            return pd.DataFrame([replace(t, key, sent.value) for t in texts], columns=["text", "kinds"])

        made = docs.withColumn(slot, apply(F.col(text)))
    else:
        held = (
            docs.select(F.xxhash64(text).alias("place"), F.col(text).alias("text"))
            .mapInPandas(_mentions, "place long, kind string, canon string")
            .distinct()
            .join(moved, ["kind", "canon"])
            .groupBy(F.col("place").alias(place))
            .agg(F.collect_list(F.struct("kind", "canon", "attempt")).alias(own))
        )

        @F.pandas_udf(schema)
        def apply_own(texts: pd.Series, lists: pd.Series) -> pd.DataFrame:
            rows = []
            for t, listed in zip(texts, lists):
                at = {(m["kind"], m["canon"]): m["attempt"] for m in listed} if listed is not None else {}
                rows.append(replace(t, key, at))
            return pd.DataFrame(rows, columns=["text", "kinds"])

        placed = docs.withColumn(place, F.xxhash64(text)).join(held, place, "left")
        made = placed.withColumn(slot, apply_own(F.col(text), F.col(own))).drop(place, own)
    parts = {text: F.col(slot)["text"], kinds: F.col(slot)["kinds"]}
    return made.withColumns(parts).drop(slot)


def _mentions(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = [(p, settled_as(e[2]), e[3]) for p, t in zip(batch["place"], batch["text"]) for e in entities(t)]
        yield pd.DataFrame(rows, columns=["place", "kind", "canon"])


def query(spark, sf_dir: str) -> DataFrame:
    """op3: all documents with surrogates for personal data."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    made = with_surrogates(docs)
    return made.select("doc_id", F.size("surrogate_kinds").alias("n_entities"), "surrogate_kinds", "text")
