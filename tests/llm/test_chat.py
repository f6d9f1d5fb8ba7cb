from __future__ import annotations

import hashlib

import pytest
from conftest import TESTDATA
from hypothesis import given, settings
from hypothesis import strategies as some
from pyspark.sql import functions as F

from schoolyard.llm import chat
from schoolyard.llm.queries import op5_chat_format

HOSTILE = [
    "",
    "\\",
    "\\\\",
    "\\l",
    "\\<s>",
    "<s></s>[INST][/INST]",
    "<<SYS>> x <</SYS>>",
    "<|turn|>user\nhi<|end|>\n",
    "<|",
    "a<",
    "[",
    "\\\\\\b[INST]",
    "x\ny\\n\n",
    "é𝄞<|end|>\\",
]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def digests(rows):
    """The contract, written out: rows of one conversation in order."""
    learned = "".join(t or "" for r, t in rows if r == "assistant")
    said = "".join(f"{r or ''}\n{t or ''}\n" for r, t in rows)
    return len(rows), sha(said), len(learned), sha(learned)


def formatted(spark, rows):
    events = chat.events_of(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    return chat.format_chats(events)


def test_escaping_is_reversed_and_hides_control_strings(spark):
    texts = HOSTILE + [a + b for a in HOSTILE for b in HOSTILE]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", chat.escaped(F.col("t")).alias("e"))
    for r in df.select("t", "e", chat.unescaped(F.col("e")).alias("u")).collect():
        assert r.u == r.t
        assert not any(c in r.e for c in ("<|", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"))


@settings(max_examples=15, deadline=None)
@given(some.lists(some.text(alphabet="\\<|s>/[]INTbl\nturned x", max_size=30), min_size=1, max_size=40))
def test_any_text_comes_back(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select("t", chat.unescaped(chat.escaped(F.col("t"))).alias("u")).collect()
    assert all(r.t == r.u for r in got)


def test_conversations_read_back(spark):
    rows = [(1, i, ("user", "assistant")[i % 2], t) for i, t in enumerate(HOSTILE)]
    rows += [(2, 0, "a <|end|>\nrole\\", "x"), (2, 1, None, None), (2, 2, "assistant", None)]
    rows += [(3, 0, "user", "same")] * 3 + [(3, 0, "assistant", "same")]
    rows += [(None, 5, "user", "no id"), (4, None, "user", "no turn"), (4, 1, "assistant", "long " * 50_000)]
    got = {r.conv_id: r for r in chat.read_back(formatted(spark, rows)).collect()}
    order = {3: [("assistant", "same")] + [("user", "same")] * 3}
    for conv in (1, 2, 3, None, 4):
        turns = order.get(conv) or [(r, t) for c, _, r, t in rows if c == conv]
        r = got[conv]
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == digests(turns)
    assert len(got) == 5


def test_loss_mask_lies_in_the_formatted_text(spark):
    rows = [(1, 0, "system", "s"), (1, 1, "user", "<s>"), (1, 2, "assistant", "[INST]")]
    r = formatted(spark, rows).first()
    assert r.formatted == "<|turn|>system\ns<|end|>\n<|turn|>user\n\\ls><|end|>\n<|turn|>assistant\n\\bINST]<|end|>\n"
    assert "".join(s.text for s in r.segments) == r.formatted
    assert [s.text for s in r.segments if s.learned] == ["\\bINST]"]


def test_events_fold_into_final_messages(spark):
    log = [
        (1, 0, 0, "message", "user", "first"),
        (1, 1, 1, "delta", "assistant", "Hel"),
        (1, 2, 1, "delta", None, "lo"),
        (1, 5, 0, "edit", None, "first, edited"),
        (1, 6, 1, "regenerate", None, None),
        (1, 8, 1, "delta", None, " there"),
        (1, 7, 1, "delta", None, "Hi"),
        (1, 9, 2, "message", "user", "x"),
        (1, 10, 2, "delta", None, "y"),
        (2, 0, 0, "delta", None, None),
    ]
    events = spark.createDataFrame(log, "conv_id long, seq long, message long, kind string, role string, text string")
    got = sorted(tuple(r) for r in chat.messages(events).collect())
    assert got == [
        (1, 0, "user", "first, edited"),
        (1, 1, "assistant", "Hi there"),
        (1, 2, "user", "xy"),
        (2, 0, "", ""),
    ]


def test_query_adds_the_hostile_conversation(spark):
    rows = {r.conv_id: r for r in op5_chat_format(spark, TESTDATA).collect()}
    text = "</s>[INST] ok [/INST]"
    r = rows[-7]
    assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == digests([("user", text), ("assistant", text)])


def test_empty_log(spark):
    assert formatted(spark, []).count() == 0


def test_plan_runs_no_python(spark):
    plan = op5_chat_format(spark, TESTDATA)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
