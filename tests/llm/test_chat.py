import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tierlake.llm import chat
from tierlake.llm.common import configure

SHAPE = "conv_id long, turn long, role string, text string"
EDGES = [
    None, "", " ", "</s>[INST] ok [/INST]", r"<\/s> <\\/s> <\s> [\INST]", "<|endoftext|>", "[ROLE]x[TEXT]y[/ROLE]",
    "<", "[", "</", "s>", "<<s>", "<</s>>", "\\", "é ß 漢字 😀 \x0b x", "ends with <", "/s> begins", " " * 1_000_000,
    "\n" * 1_000_000, "x" * 300_000, "long " * 100_000,
]


def plain(rows):
    """Texts joined in order, without any tokens."""
    convs = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "")):
        convs.setdefault(conv, []).append((role or "", text or ""))
    made = []
    for conv, turns in convs.items():
        whole = "<s>"
        for role, text in turns:
            opening, closing = chat.MARKS.get(role, (f"[ROLE]{chat.escape(role)}[TEXT]", "[/ROLE]"))
            whole += (opening or "") + chat.escape(text) + closing
        learned = "".join(text for role, text in turns if role == "assistant")
        told = "".join(f"{role}\n{text}\n" for role, text in turns)
        made.append((conv, len(turns), hashlib.sha256(told.encode()).hexdigest(), len(learned),
                     hashlib.sha256(learned.encode()).hexdigest(), len(whole)))
    return sorted(made, key=str)


def got(spark, rows):
    configure(spark)
    frame = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], SHAPE + ", position int, ids string, conv string")
    return sorted([tuple(r) for r in chat.digests(chat.format_turns(frame)).collect()], key=str)


def test_edges(spark):
    roles = ["user", "assistant", "system", "tool", None, "", "<s>[/ROLE]"]
    rows = [(conv, i, role, text) for conv, role in enumerate(roles) for i, text in enumerate(EDGES)]
    rows += [(None, 0, "user", "a"), (None, 1, "assistant", "b"), (50, None, "user", "first"), (50, 0, "assistant", "then"),
             (51, 0, "user", "tie"), (51, 0, "assistant", "tie"), (52, 0, "assistant", "again"), (52, 0, "assistant", "again")]
    assert got(spark, rows) == plain(rows)
    assert got(spark, []) == []


@pytest.mark.parametrize("partitions", ["1", "3", "40"])
def test_one_conversation_over_many_partitions(spark, partitions):
    rows = [(7, i, ["user", "assistant"][i % 2], f"text {i} " * (i % 9)) for i in range(900)]
    rows += [(i, 0, "user", "only") for i in range(-20, 40) if i != 7] + [(None, i, "assistant", f"n{i}") for i in range(300)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        assert got(spark, rows) == plain(rows)
        frame = spark.createDataFrame(rows, SHAPE)
        formatted = chat.format_turns(frame).where("conv_id = 7").orderBy("position").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert [r["position"] for r in formatted] == list(range(900))
    at = 0
    for r in formatted:
        assert r["start"] == at and len(r["ids"]) == chat.id_kind().itemsize * r["length"] and len(r["mask"]) == r["length"]
        at += r["length"]


def test_read_back_and_mask(spark):
    rows = [(1, i, ["user", "assistant", "tool"][i % 3], text) for i, text in enumerate(EDGES[:14])]
    formatted = chat.format_turns(spark.createDataFrame(rows, SHAPE))
    back = {r["position"]: r for r in chat.read_back(formatted).collect()}
    for i, (_, _, role, text) in enumerate(rows):
        assert (back[i]["role"], back[i]["text"]) == (role, text or "")
        assert back[i]["learned"] == (text or "" if role == "assistant" else "")
    reserved = chat.vocabulary_size()
    for r in formatted.collect():
        ids, mask = np.frombuffer(r["ids"], chat.id_kind()), np.frombuffer(r["mask"], np.int8)
        assert not mask[ids >= reserved].any() and set(mask.tolist()) <= {0, 1}


texts = st.lists(st.sampled_from(["<", "[", "\\", "/s>", "s>", "INST]", "</s>", "[/INST]", "x", "<|endoftext|>"]), max_size=12).map("".join)


@settings(max_examples=300, deadline=None)
@given(texts)
def test_escapes_are_reversible_and_leave_no_control_string(text):
    escaped = chat.escape(text)
    assert chat.unescape(escaped) == text
    assert not any(control in escaped for control in [*chat.CONTROLS, chat.SPECIAL])
    for control in chat.CONTROLS:  # nor does one arise where a mark begins or ends
        joined = control + escaped + control
        assert sum(joined.count(c) for c in chat.CONTROLS) == 2
