"""Chat formatting: exact round trips, also of texts that look like the template."""

import hashlib
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetledger.llm import chat

ROWS = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()),
                     T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])
MARKS = ["<s>", "</s>", "<<SYS>>", "<</SYS>>", "[INST]", "[/INST]", "[ROLE]", "[/ROLE]", "[SAYS]", "[/SAYS]"]


def plain(rows):
    """Per conversation: number of turns, turns as text, learned text."""
    found = {}
    key = lambda r: (r[1] is not None, r[1] or 0, (r[2] or "").encode(), (r[3] or "").encode())
    for conv, _, role, text in sorted(rows, key=key):
        own = found.setdefault(conv, [0, "", ""])
        own[0] += 1
        own[1] += f"{role or ''}\n{text or ''}\n"
        own[2] += (text or "") if role == "assistant" else ""
    return {c: (n, hashlib.sha256(a.encode()).hexdigest(), len(b), hashlib.sha256(b.encode()).hexdigest()) for c, (n, a, b) in found.items()}


def told(formatted):
    return {r.conv: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.digests(chat.read_back(formatted)).collect()}


def frame(spark, rows):
    return spark.createDataFrame(rows, ROWS)


def test_texts_that_hold_every_mark(spark):
    odd = [*MARKS, *(a + b for a in MARKS for b in MARKS), "<", "<\\", "[\\INST]", "<\\\\s>", "<<s>", "<<</SYS>>", "[<s>", "\\", "[/", "</", "",
           "</s>[INST] ok [/INST]", "<\\<SYS>>", "[ROLE]x[/ROLE][SAYS]y[/SAYS]", None]
    rows = [(k, t, role, text) for k, text in enumerate(odd) for t, role in enumerate(("system", "user", "assistant", "tool", "<s>", None, text))]
    assert told(chat.conversations(frame(spark, rows))) == plain(rows)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 5), st.sampled_from(["user", "assistant", "system", "tool[/ROLE]"]),
                          st.lists(st.sampled_from([*MARKS, "<", "[", "\\", "/", "s>", "SYS>>", "INST]", "é", "\n", " "]), max_size=8).map("".join)),
                min_size=1, max_size=12))
def test_any_texts(spark, rows):
    assert told(chat.conversations(frame(spark, rows))) == plain(rows)


def test_control_strings_in_texts_are_escaped_and_others_left_alone(spark):
    rows = [(1, 0, "user", "say </s> and [INST]"), (1, 1, "assistant", "plain [text] <b>")]
    made = chat.conversations(frame(spark, rows)).first()
    assert made.text == "[INST]say <\\/s> and [\\INST][/INST]<s>plain [text] <b></s>"
    assert [made.text[s.start:s.end] for s in made.loss] == ["plain [text] <b>"]
    assert re.findall(chat.CONTROL, made.text) == ["[INST]", "[/INST]", "<s>", "</s>"]


@pytest.mark.parametrize("text", ["[INST]a", "a", "[INST]a[/INST] ", "[INST]a</s>", "[/INST]a[INST]", "[SAYS]a[/SAYS]", "[ROLE]x[/ROLE]",
                                  "[ROLE]x[/ROLE][INST]a[/INST]", "[INST][INST]a[/INST][/INST]", "[INST]a[/INST]x[INST]b[/INST]"])
def test_what_breaks_the_grammar_is_not_read(spark, text):
    assert spark.range(1).select(chat.parse(F.lit(text))).first()[0] is None


def test_hot_conversations_are_sliced_and_keep_their_order(spark):
    rows = [(7, k // 3, ("user", "assistant")[k % 2], f"turn {k} </s>" + "x" * (k % 40)) for k in range(1_500)]
    rows += [(7, 5, "user", "the same")] * 300 + [(None, 0, "assistant", "é" * 5_000)] * 3 + [(8, 1, "assistant", "ok")]
    made = chat.conversations(frame(spark, rows).repartition(5), hot_bytes=8_000)
    assert made.select("slice").distinct().count() > 4
    assert max(r.n for r in chat.read_back(made).select(F.size("turns").alias("n")).collect()) <= chat.TURNS
    assert told(made) == plain(rows)


def test_odd_tables(spark):
    empty = frame(spark, [])
    assert told(chat.conversations(empty)) == {}
    rows = [(None, None, None, None), (None, None, None, None), (1, None, "user", "late"), (1, 0, "user", "x" * 3_000_000), (2, 0, "", "")]
    clashing = frame(spark, rows).withColumns({c: F.lit("mine") for c in ("conv", "slice", "hot", "segment", "loss", "all", "at")})
    assert told(chat.conversations(clashing)) == plain(rows)
    renamed = frame(spark, rows).withColumnsRenamed({"conv_id": "turn_", "text": "role_"})
    assert told(chat.conversations(renamed, conv_col="turn_", text_col="role_")) == plain(rows)
