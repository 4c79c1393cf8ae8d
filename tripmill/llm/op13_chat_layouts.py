"""Chat formatting by schema fingerprints, with DataFrame functions alone.

A record is a variant (a parsed JSON text or a struct turned into one). Its nested field paths, written as a tree without
the types of leaves and restricted to the root fields that any layout names, are hashed; the hash selects a declarative
mapping (``LAYOUTS``) that says where the turns are. So one column may hold prompts with answers, instructions with
input, message lists under different names, and rows of single messages. Other root fields (ids, sources, metadata) play
no part. ``census`` lists every fingerprint with its layout, and counts those that still need a mapping.

Canonical turns are put into one text per conversation: marks around each turn, control strings inside texts escaped by a
backslash after their first character (backslashes are doubled), so that no text can open or close a turn. The loss mask
is kept as ``segments``, the runs of the formatted text in order, each with a flag. ``read_back`` gets the turns from the
marks and the learned text from the mask.

Only whole conversations are shuffled, once, as raw turns. A formatted conversation is one cell, so it has to fit Spark's
2 GB; a conversation's turns meet in one task because its text is one value.

Defined cases: a null role or text is empty; turns are ordered by their number (nulls first), then role, then text, and
repeated rows count each time; records of one id are one conversation, a null id is an id of its own; a record that is
null, no object or of an unknown layout gives no turn and stays in ``census`` and ``unmapped``; an empty table gives no
rows; extra columns of any name are not read.
"""

from __future__ import annotations

from itertools import combinations
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.llm.common import table


class Rows(NamedTuple):
    """The record is one turn of a conversation; ``order`` is the path of its number."""

    order: str
    role: str
    text: str


class Listed(NamedTuple):
    """The turns are the elements of a list; ``parts`` names a list inside the text field whose texts are joined."""

    path: str
    role: str
    text: str
    parts: str | None = None


class Said(NamedTuple):
    """One turn of a fixed role, its text from one or more paths; without text, ``needed`` turns stay, others go."""

    role: str
    paths: tuple[str, ...]
    needed: bool = True


class Layout(NamedTuple):
    """Nested field paths of a layout (``[]`` is a list) and where its turns are, in order."""

    name: str
    paths: tuple[str, ...]
    turns: tuple[Rows | Listed | Said, ...]
    optional: tuple[str, ...] = ()


# Known layouts, other names of roles, marks and control strings of the template.
_SYSTEM = Said("system", ("system",), needed=False)
LAYOUTS = (
    Layout("message rows", ("turn", "role", "text"), (Rows("turn", "role", "text"),)),
    Layout(
        "messages",
        ("messages[].role", "messages[].content"),
        (_SYSTEM, Listed("messages", "role", "content")),
        ("messages[].name", "system"),
    ),
    Layout(
        "message parts",
        ("messages[].role", "messages[].content[].type", "messages[].content[].text"),
        (_SYSTEM, Listed("messages", "role", "content", "text")),
        ("system",),
    ),
    Layout(
        "from and value",
        ("conversations[].from", "conversations[].value"),
        (_SYSTEM, Listed("conversations", "from", "value")),
        ("system", "conversations[].weight"),
    ),
    Layout(
        "prompt messages",
        ("prompt[].role", "prompt[].content", "completion[].role", "completion[].content"),
        (Listed("prompt", "role", "content"), Listed("completion", "role", "content")),
    ),
    Layout("prompt and completion", ("prompt", "completion"), (_SYSTEM, Said("user", ("prompt",)), Said("assistant", ("completion",))), ("system",)),
    Layout("prompt and response", ("prompt", "response"), (_SYSTEM, Said("user", ("prompt",)), Said("assistant", ("response",))), ("system",)),
    Layout("question and answer", ("question", "answer"), (_SYSTEM, Said("user", ("context", "question")), Said("assistant", ("answer",))), ("system", "context")),
    Layout("instruction and output", ("instruction", "output"), (_SYSTEM, Said("user", ("instruction", "input")), Said("assistant", ("output",))), ("system", "input")),
    Layout("instruction and response", ("instruction", "response"), (_SYSTEM, Said("user", ("instruction", "context")), Said("assistant", ("response",))), ("system", "context")),
)
ROLE_NAMES = {"human": "user", "gpt": "assistant", "model": "assistant", "bot": "assistant"}
MARKS = {"user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>"), "system": ("<<SYS>>", "<</SYS>>")}
ROLE_OPEN, ROLE_CLOSE, TEXT_CLOSE = "<<ROLE>>", "<</ROLE>>", "<</TEXT>>"
LEARNED = "assistant"
#: What follows the first character of a control string.
AFTER_ANGLE = ("s>", "/s>", "<SYS>>", "</SYS>>", "<ROLE>>", "</ROLE>>", "</TEXT>>", "|endoftext|>", "|im_start|>", "|im_end|>")
AFTER_BRACKET = ("INST]", "/INST]")
SAMPLE_TEXT = "</s>[INST] ok [/INST]"

_TURN_TYPE = "array<struct<place: bigint, at: int, role: string, text: string>>"


def _root(path: str) -> str:
    return path.partition(".")[0].removesuffix("[]")


def roots(layouts: tuple[Layout, ...] = LAYOUTS) -> list[str]:
    """The root fields that any layout names."""
    return sorted({_root(p) for layout in layouts for p in (*layout.paths, *layout.optional)})


def path_tree(paths: tuple[str, ...]) -> str:
    """Paths as the tree that ``tree_of`` finds in records that have them."""
    tree: dict = {}
    for path in paths:
        at = tree
        for step in path.replace("[]", ".[]").split("."):
            at = at.setdefault(step, {})

    def written(node: dict) -> str:
        if "[]" in node:
            return f"ARRAY<{written(node['[]'])}>"
        return "OBJECT<" + ", ".join(f"{k}: {written(v)}" for k, v in sorted(node.items())) + ">" if node else ""

    return "; ".join(f"{k}: {written(v)}" for k, v in sorted(tree.items()))


def tree_of(record: Column, layouts: tuple[Layout, ...] = LAYOUTS) -> Column:
    """The nested field paths of a record below the root fields that layouts name, as a tree without leaf types."""
    found = [
        F.concat(F.lit(f"{root}: "), F.schema_of_variant(F.try_variant_get(record, f"$.{root}", "variant")))
        for root in roots(layouts)
    ]
    return F.regexp_replace(F.concat_ws("; ", *found), r"(: |ARRAY<)(?!OBJECT<|ARRAY<)[A-Z_]+(\(\d+,\d+\))?", "$1")


def fingerprint(tree: Column) -> Column:
    return F.sha2(tree, 256)


def layout_trees(layout: Layout) -> list[str]:
    """One tree for every choice of optional paths."""
    return [
        path_tree((*layout.paths, *chosen))
        for n in range(len(layout.optional) + 1)
        for chosen in combinations(layout.optional, n)
    ]


def selects(layout: Layout, print_: Column) -> Column:
    return print_.isin([fingerprint(F.lit(tree)) for tree in layout_trees(layout)])


def layout_name(print_: Column, layouts: tuple[Layout, ...] = LAYOUTS) -> Column:
    return F.coalesce(*[F.when(selects(layout, print_), F.lit(layout.name)) for layout in layouts])


def _text(record: Column, path: str) -> Column:
    return F.try_variant_get(record, f"$.{path}", "string")


def _listed(record: Column, spec: Listed) -> Column:
    """The elements of a list as turns, its roles by their usual names."""
    inner = f"array<struct<`{spec.parts}`: string>>" if spec.parts else "string"
    listed = F.try_variant_get(record, f"$.{spec.path}", f"array<struct<`{spec.role}`: string, `{spec.text}`: {inner}>>")

    def turn(x: Column) -> Column:
        text, role = x[spec.text], x[spec.role]
        if spec.parts:
            text = F.array_join(F.transform(text, lambda part: part[spec.parts]), "")
        for other, name in ROLE_NAMES.items():
            role = F.when(x[spec.role] == other, F.lit(name)).otherwise(role)
        return F.struct(F.lit(None).cast("bigint").alias("place"), F.lit(0).alias("at"), role.alias("role"), text.alias("text"))

    return F.coalesce(F.transform(listed, turn), F.array().cast(_TURN_TYPE))


def _turns(record: Column, layout: Layout) -> Column:
    """The turns of a record by the layout's mapping."""
    steps = []
    for spec in layout.turns:
        if isinstance(spec, Rows):
            one = F.struct(
                F.try_variant_get(record, f"$.{spec.order}", "bigint").alias("place"),
                F.lit(0).alias("at"),
                _text(record, spec.role).alias("role"),
                _text(record, spec.text).alias("text"),
            )
            steps.append(F.array(one))
        elif isinstance(spec, Listed):
            steps.append(_listed(record, spec))
        else:
            parts = [F.when(_text(record, p) != "", _text(record, p)) for p in spec.paths]
            one = F.struct(
                F.lit(None).cast("bigint").alias("place"),
                F.lit(0).alias("at"),
                F.lit(spec.role).alias("role"),
                F.concat_ws("\n\n", *parts).alias("text"),
            )
            kept = F.array(one)
            steps.append(kept if spec.needed else F.when(F.coalesce(*parts).isNotNull(), kept).otherwise(F.array().cast(_TURN_TYPE)))
    if isinstance(layout.turns[0], Rows):
        return steps[0].cast(_TURN_TYPE)
    # Turns inside a record are numbered by their place in it.
    return F.transform(
        F.concat(*[s.cast(_TURN_TYPE) for s in steps]),
        lambda t, i: F.struct(i.cast("bigint").alias("place"), i.alias("at"), t["role"].alias("role"), t["text"].alias("text")),
    ).cast(_TURN_TYPE)


def census(records: DataFrame, record: str = "record", layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """(fingerprint, tree, layout, n): every layout that occurs; ``layout`` is null where a mapping is missing."""
    tree = tree_of(F.col(record), layouts)
    counted = records.select(tree.alias("tree")).groupBy("tree").agg(F.count(F.lit(1)).alias("n"))
    print_ = fingerprint(F.col("tree"))
    return counted.select(print_.alias("fingerprint"), "tree", layout_name(print_, layouts).alias("layout"), "n")


def unmapped(records: DataFrame, record: str = "record", layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """The records that no mapping fits, as they came."""
    return records.filter(layout_name(fingerprint(tree_of(F.col(record), layouts)), layouts).isNull())


def canonical_turns(
    records: DataFrame, key: str = "conv_id", record: str = "record", layouts: tuple[Layout, ...] = LAYOUTS
) -> DataFrame:
    """(key, place, at, role, text): the turns of all records whose layout is known; null roles and texts are empty."""
    own = records.select(F.col(key).alias("key"), F.col(record).alias("record"))
    own = own.withColumn("print", fingerprint(tree_of(F.col("record"), layouts)))
    turns = F.coalesce(*[F.when(selects(layout, F.col("print")), _turns(F.col("record"), layout)) for layout in layouts])
    turn = own.select("key", F.explode(turns).alias("turn"))
    return turn.select(
        F.col("key").alias(key),
        F.col("turn.place").alias("place"),
        F.col("turn.at").alias("at"),
        F.coalesce("turn.role", F.lit("")).alias("role"),
        F.coalesce("turn.text", F.lit("")).alias("text"),
    )


def _literal(text: str) -> str:
    return "".join("\\" + c if c in "[]()|\\.*+?{}^$" else c for c in text)


_ANGLE = "|".join(map(_literal, AFTER_ANGLE))
_BRACKET = "|".join(map(_literal, AFTER_BRACKET))
_PAIRS = [*MARKS.values(), (ROLE_OPEN, TEXT_CLOSE)]
_TURN = "(?s)" + "|".join(f"{_literal(a)}.*?{_literal(b)}" for a, b in _PAIRS)


def escaped(text: Column) -> Column:
    """The text with backslashes doubled and control strings broken by a backslash."""
    doubled = F.regexp_replace(text, r"\\", r"\\\\")
    return F.regexp_replace(doubled, rf"<(?={_ANGLE})|\[(?={_BRACKET})", r"$0\\")


def unescaped(text: Column) -> Column:
    """A backslash stands for itself when another follows, and for nothing elsewhere."""
    return F.regexp_replace(text, r"\\(\\?)", "$1")


def formatted_conversations(turns: DataFrame, key: str = "conv_id") -> DataFrame:
    """(key, formatted, segments): one text per conversation, and its runs (text, loss) in order."""
    ordered = F.sort_array(F.collect_list(F.struct("place", "at", "role", "text")))
    whole = turns.groupBy(key).agg(ordered.alias("turns"))

    def runs(t: Column) -> Column:
        head, tail = F.concat(F.lit(ROLE_OPEN), escaped(t["role"]), F.lit(ROLE_CLOSE)), F.lit(TEXT_CLOSE)
        for role, (begins, ends) in MARKS.items():
            head = F.when(t["role"] == role, F.lit(begins)).otherwise(head)
            tail = F.when(t["role"] == role, F.lit(ends)).otherwise(tail)
        return F.array(
            F.struct(head.alias("text"), F.lit(False).alias("loss")),
            F.struct(escaped(t["text"]).alias("text"), (t["role"] == LEARNED).alias("loss")),
            F.struct(tail.alias("text"), F.lit(False).alias("loss")),
        )

    segments = whole.select(key, F.flatten(F.transform("turns", runs)).alias("segments"))
    return segments.select(key, F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"), "segments")


def read_back(formatted: Column, segments: Column) -> tuple[Column, Column]:
    """The turns (role, text) that the marks enclose, and the unescaped text under the loss mask."""

    def turn(m: Column) -> Column:
        inner = F.substring(m, F.lit(len(ROLE_OPEN) + 1), F.char_length(m) - len(ROLE_OPEN) - len(TEXT_CLOSE))
        role = F.substring_index(inner, ROLE_CLOSE, 1)
        text = F.substring(inner, F.char_length(role) + len(ROLE_CLOSE) + 1, F.char_length(inner))
        for name, (begins, ends) in MARKS.items():
            own = F.substring(m, F.lit(len(begins) + 1), F.char_length(m) - len(begins) - len(ends))
            text = F.when(m.startswith(begins), own).otherwise(text)
            role = F.when(m.startswith(begins), F.lit(name)).otherwise(role)
        return F.struct(unescaped(role).alias("role"), unescaped(text).alias("text"))

    turns = F.transform(F.regexp_extract_all(formatted, F.lit(_TURN), F.lit(0)), turn)
    learned = F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescaped(s["text"]))
    return turns, F.array_join(learned, "")


def digests(formatted: DataFrame, key: str = "conv_id") -> DataFrame:
    """Counts and digests of what is read back from formatted conversations."""
    turns, learned = read_back(F.col("formatted"), F.col("segments"))
    read = formatted.select(key, turns.alias("turns"), learned.alias("learned"), F.char_length("formatted").cast("long").alias("formatted_chars"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        key,
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.char_length("learned").cast("long").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        "formatted_chars",
    )


def query(spark, sf_dir: str) -> DataFrame:
    """op13: all conversations (message rows) and conversation -7 (a message list), formatted and read back."""
    rows = table(spark, sf_dir, "conversations").select(
        "conv_id", F.to_variant_object(F.struct("turn", "role", "text")).alias("record")
    )
    said = [F.struct(F.lit(role).alias("role"), F.lit(SAMPLE_TEXT).alias("content")) for role in ("user", "assistant")]
    sample = spark.range(1).select(
        F.lit(-7).cast("long").alias("conv_id"), F.to_variant_object(F.struct(F.array(*said).alias("messages"))).alias("record")
    )
    return digests(formatted_conversations(canonical_turns(rows.unionByName(sample))))


_SQL_CONTROL = "|".join(["<(?:" + _ANGLE + ")", r"\[(?:" + _BRACKET + ")"])

SQL = rf"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '{SAMPLE_TEXT}'
    UNION ALL SELECT -7, 1, 'assistant', '{SAMPLE_TEXT}'
),
sized AS (
    SELECT *,
        length(text) + (length(text) - length(replace(text, '\', ''))) + len(regexp_extract_all(text, '{_SQL_CONTROL}')) AS text_chars,
        length(role) + (length(role) - length(replace(role, '\', ''))) + len(regexp_extract_all(role, '{_SQL_CONTROL}')) AS role_chars
    FROM turns
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
    sum(text_chars + CASE role WHEN 'user' THEN {sum(map(len, MARKS["user"]))} WHEN 'assistant' THEN {sum(map(len, MARKS["assistant"]))}
        WHEN 'system' THEN {sum(map(len, MARKS["system"]))} ELSE {len(ROLE_OPEN + ROLE_CLOSE + TEXT_CLOSE)} + role_chars END)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""
