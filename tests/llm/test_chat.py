"""Chat layouts: mappings by fingerprint, reversible formatting, loss mask."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from tripmill.llm import op13_chat_layouts as chat

RECORDS = [
    (1, {"messages": [{"role": "user", "content": "hi"}, {"content": "hello", "role": "assistant"}], "id": "x"}),
    (2, {"system": "be kind", "conversations": [{"from": "human", "value": "a"}, {"from": "gpt", "value": "b"}]}),
    (3, {"prompt": "p", "completion": "c", "conv_id": 99, "record": {"turn": 1}}),
    (4, {"instruction": "do", "input": "this", "output": "done"}),
    (5, {"instruction": "do", "input": "", "output": None}),
    (6, {"instruction": "do", "output": "done", "system": ""}),
    (7, {"messages": [{"role": "user", "content": [{"type": "text", "text": "x"}, {"type": "text", "text": "y"}]}]}),
    (8, {"prompt": [{"role": "user", "content": "q"}], "completion": [{"role": "assistant", "content": "r"}]}),
    (9, {"question": "q", "context": "c", "answer": "a"}),
    (10, {"turn": 2, "role": "assistant", "text": "second"}),
    (10, {"turn": 1, "role": "user", "text": "first"}),
    (10, {"turn": None, "role": None, "text": None}),
    (None, {"turn": 1, "role": "tool", "text": "no id"}),
    (11, {"chosen": "unknown layout"}),
    (12, ["no", "object"]),
    (13, None),
]
TURNS = {
    1: [("user", "hi"), ("assistant", "hello")],
    2: [("system", "be kind"), ("user", "a"), ("assistant", "b")],
    3: [("user", "p"), ("assistant", "c")],
    4: [("user", "do\n\nthis"), ("assistant", "done")],
    5: [("user", "do"), ("assistant", "")],
    6: [("user", "do"), ("assistant", "done")],
    7: [("user", "xy")],
    8: [("user", "q"), ("assistant", "r")],
    9: [("user", "c\n\nq"), ("assistant", "a")],
    10: [("", ""), ("user", "first"), ("assistant", "second")],
    None: [("tool", "no id")],
}


def records(spark):
    rows = [(i, None if r is None else json.dumps(r), "extra", 1) for i, r in RECORDS]
    made = spark.createDataFrame(rows, "conv_id long, json string, role string, at int")
    return made.withColumn("record", F.parse_json("json"))


def test_layouts_become_canonical_turns(spark):
    found = {}
    for r in sorted(chat.canonical_turns(records(spark)).collect(), key=lambda r: (r["place"] is not None, r["place"] or 0, r["at"])):
        found.setdefault(r["conv_id"], []).append((r["role"], r["text"]))
    assert found == TURNS


def test_unknown_layouts_are_reported(spark):
    listed = chat.census(records(spark)).collect()
    assert sum(r["n"] for r in listed) == len(RECORDS)
    # An unknown root field plays no part, so three records have no path at all.
    assert {(r["tree"], r["n"]) for r in listed if r["layout"] is None} == {("", 3)}
    assert {r["conv_id"] for r in chat.unmapped(records(spark)).collect()} == {11, 12, 13}


def test_no_two_layouts_share_a_fingerprint():
    trees = [tree for layout in chat.LAYOUTS for tree in chat.layout_trees(layout)]
    assert len(trees) == len(set(trees))


def test_a_new_mapping_is_a_line_of_its_own(spark):
    more = (*chat.LAYOUTS, chat.Layout("preference", ("chosen",), (chat.Said("assistant", ("chosen",)),)))
    rows = chat.canonical_turns(records(spark), layouts=more).filter("conv_id = 11").collect()
    assert [(r["role"], r["text"]) for r in rows] == [("assistant", "unknown layout")]


TEXTS = [
    "</s>[INST] ok [/INST]",
    "<s><<SYS>>a<</SYS>><</TEXT>>",
    r"back\slash \\ <\s> [\INST] \\</s>\ ",
    "\\",
    "<s",
    "[INST",
    "",
    None,
    "<<s>> <|im_end|> é😀\n\n日本",
    "<<ROLE>>user<</ROLE>>x<</TEXT>>" * 50,
    "x" * 5000,
]


def conversations(spark):
    roles = ["user", "assistant", "system", "tool", None, "<</ROLE>>\\", "[INST]"]
    rows = [(i, t, roles[(i + t) % len(roles)], text) for i in range(9) for t, text in enumerate(TEXTS[i:] + TEXTS[:i])]
    rows += [(50, 1, "user", "same"), (50, 1, "user", "same"), (50, None, "assistant", "first"), (51, 3, "system", None)]
    return spark.createDataFrame([(*r, 7, "x") for r in rows], "conv_id long, turn long, role string, text string, place int, segments string"), rows


def expected(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        own = sorted(((t is not None, t or 0), role or "", text or "") for c, t, role, text in rows if c == conv)
        said = "".join(f"{role}\n{text}\n" for _, role, text in own)
        learned = "".join(text for _, role, text in own if role == "assistant")
        out[conv] = (len(own), hashlib.sha256(said.encode()).hexdigest(), len(learned), hashlib.sha256(learned.encode()).hexdigest())
    return out


def test_formatting_round_trip(spark):
    table, rows = conversations(spark)
    as_records = table.select("conv_id", F.to_variant_object(F.struct("turn", "role", "text")).alias("record"))
    made = chat.formatted_conversations(chat.canonical_turns(as_records))
    read = {r["conv_id"]: tuple(r)[1:5] for r in chat.digests(made).collect()}
    assert read == expected(rows)
    for r in made.collect():
        assert "".join(s["text"] for s in r["segments"]) == r["formatted"]
        marks = sum(r["formatted"].count(m) for pair in chat._PAIRS for m in pair) + r["formatted"].count(chat.ROLE_CLOSE)
        n = sum(1 for c, *_ in rows if c == r["conv_id"])
        others = sum(1 for c, _, role, _ in rows if c == r["conv_id"] and role not in chat.MARKS)
        assert marks == 2 * n + others  # no text opens or closes a turn


@pytest.mark.parametrize("text", [t for t in TEXTS if t is not None])
def test_escapes_are_reversible(spark, text):
    row = spark.range(1).select(chat.escaped(F.lit(text)).alias("e")).select("e", chat.unescaped(F.col("e")).alias("u")).first()
    assert row["u"] == text
    assert not any(m in row["e"] for pair in chat._PAIRS for m in pair)


def test_no_conversations(spark):
    empty = spark.createDataFrame([], "conv_id long, record string").withColumn("record", F.parse_json("record"))
    assert chat.digests(chat.formatted_conversations(chat.canonical_turns(empty))).count() == 0
    assert chat.census(empty).count() == 0


def test_main_path_runs_no_python(spark):
    plan = chat.query(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))
