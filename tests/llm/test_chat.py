import random
import re

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from granary.llm import chat

TURN = "conv_id bigint, turn bigint, role string, text string"


def test_any_text_comes_back(docs):
    rnd = random.Random(1)
    bits = ["</s>", "[INST]", "[/INST]", "<|turn|>", "<|end|>", "\n", "\\", "<", "[", "|>", "a", "é", "\U0001f600", "$1", "<s>"]
    rows = [(c, t, rnd.choice(["user", "assistant", "sys tem\n"]), "".join(rnd.choices(bits, k=rnd.randint(0, 8))))
            for c in range(60) for t in range(rnd.randint(1, 5))]
    chats = chat.format_chats(docs(rows, TURN).withColumn("parts", chat.text_parts(F.col("text"))))
    got = {r.conv_id: r for r in chats.select(
        "conv_id", "formatted", chat.read_turns(F.col("formatted")).alias("turns"),
        chat.read_loss(F.col("formatted"), F.col("loss")).alias("loss")).collect()}
    for c in range(60):
        own = [(r, x) for k, _, r, x in rows if k == c]
        assert [(t.role, t.text) for t in got[c].turns] == own
        assert got[c].loss == "".join(x for r, x in own if r == "assistant")
        marks = [m[0] for m in re.finditer(chat.CONTROL, got[c].formatted)]
        assert marks == [chat.TURN, chat.END] * len(own)


def test_attachments_become_ordered_placeholders(docs):
    part = lambda t, x=None, ref=None, units=None: (t, x, ref, units)
    parts = [part("text", "see <|image|> "), part("image", ref="a.png", units=4), part("audio", ref="b.wav"), None,
             part("document", ref="c.pdf", units=2), part("text", None), part("text", "end")]
    df = docs([(1, 0, "user", parts), (1, 1, "assistant", None)], f"conv_id bigint, turn bigint, role string, parts {chat.PART_TYPE}")
    row = chat.format_chats(df).collect()[0]
    assert row.formatted == ("<|turn|>user\nsee <\\|image|> <|image|><|audio|><|document|><|part|>end<|end|>\n"
                             "<|turn|>assistant\n<|end|>\n")
    assert [tuple(a) for a in row.attachments] == [("image", "a.png", 1024), ("audio", "b.wav", 25), ("document", "c.pdf", 1024)]
    assert [tuple(s) for s in row.loss] == [(row.formatted.index("assistant") + 10, 0)]


def test_random_parts_come_back_part_by_part(docs):
    rnd = random.Random(7)
    bits = ["</s>", "<|", "|>", "end", "<|en", "d|>", "\\", "image", "<|image|>", "<|part|>", "\n", "a", "é", "<", "|"]
    chats = {}
    for c in range(60):
        for t in range(rnd.randint(1, 3)):
            parts = []
            for _ in range(rnd.randint(0, 5)):
                if rnd.random() < 0.4:
                    kind = rnd.choice(["image", "audio", "document"])
                    parts.append((kind, None, f"r{rnd.randint(0, 99)}", rnd.choice([None, 3])))
                else:
                    parts.append(("text", "".join(rnd.choices(bits, k=rnd.randint(1, 6))), None, None))
            chats.setdefault(c, []).append((rnd.choice(["user", "assistant"]), parts))
    rows = [(c, t, role, parts) for c, turns in chats.items() for t, (role, parts) in enumerate(turns)]
    df = docs(rows, f"conv_id bigint, turn bigint, role string, parts {chat.PART_TYPE}")
    made = chat.format_chats(df).select(
        "*", chat.read_parts(F.col("formatted"), F.col("attachments")).alias("back"),
        chat.read_turns(F.col("formatted")).alias("turns"), chat.read_loss(F.col("formatted"), F.col("loss")).alias("said"))
    assert "Python" not in made._jdf.queryExecution().toString()
    cost = lambda kind, units: None if kind == "text" else chat.UNIT_TOKENS[kind] * (units or 1)
    for r in made.collect():
        want = [(role, [(k, x, ref, cost(k, n)) for k, x, ref, n in parts]) for role, parts in chats[r.conv_id]]
        assert [(t.role, [tuple(p) for p in t.parts]) for t in r.back] == want
        text = lambda parts: "".join(chat.PLACEHOLDERS.get(k, x) for k, x, *_ in parts)
        assert [(t.role, t.text) for t in r.turns] == [(role, text(parts)) for role, parts in chats[r.conv_id]]
        assert r.said == "".join(text(p) for role, p in chats[r.conv_id] if role == "assistant")


def test_a_part_of_an_unknown_kind_raises(docs):
    df = docs([(1, 0, "user", [("video", None, "v.mp4", None)])], f"conv_id bigint, turn bigint, role string, parts {chat.PART_TYPE}")
    with pytest.raises(PySparkException, match="no known kind: video"):
        chat.format_chats(df).collect()


def test_nulls_ties_and_empty_table(docs):
    df = docs([(None, None, None, None), (1, 5, "user", "b"), (1, 5, "user", "a")], TURN)
    made = chat.format_chats(df.withColumn("parts", chat.text_parts(F.col("text"))))
    got = {r.conv_id: [tuple(t) for t in r.turns] for r in made.select("conv_id", chat.read_turns(F.col("formatted")).alias("turns")).collect()}
    assert got == {None: [("", "")], 1: [("user", "a"), ("user", "b")]}
    empty = docs([], TURN).withColumn("parts", chat.text_parts(F.col("text")))
    assert chat.format_chats(empty).collect() == []
    plan = made._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan
