"""Chat formatting: layouts, reversible escapes, loss masks."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from docflow.llm import chat

HARD = ["", "plain", "</s>[INST] ok [/INST]", "a\\b", "\\", "<|im_end|>", "<\\|im_end|>", "<<SYS>>x<</SYS>>", "<<|im_sep|>", "\n<s>\n", "ünï 😀 \\n"]


def conversations(spark, rows):
    return spark.createDataFrame([(c, t, r, x, "clash") for c, t, r, x in rows], "conv_id long, turn long, role string, text string, record string")


def want(rows):
    by = {}
    for c, t, r, x in rows:
        by.setdefault(c, []).append((t if t is not None else -1, r or "", x or ""))
    out = {}
    for c, turns in by.items():
        turns.sort()
        joined = "".join(f"{r}\n{x}\n" for _, r, x in turns)
        loss = "".join(x for _, r, x in turns if r == "assistant")
        out[c] = (len(turns), hashlib.sha256(joined.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def test_round_trip_of_hard_texts(spark):
    rows = [(i, t, r, x) for i, x in enumerate(HARD) for t, r in enumerate(["user", "assistant"])]
    rows += [(50, 0, "system", "s"), (50, 1, "user", HARD[2]), (50, 2, "assistant", HARD[5]), (51, 0, "assistant", None), (52, 2, "user", "b"), (52, 1, "assistant", "a"), (52, 1, "assistant", "a"), (53, 0, None, "x"), (54, 0, "a<|im_sep|>b", "t"), (None, 0, "user", "n"), (56, None, "user", "q"), (57, 0, "user", "x" * 200_000)]
    got = {r.conv_id: tuple(r)[1:5] for r in chat.digests(chat.format_conversations(chat.records_of(conversations(spark, rows)))).collect()}
    assert got == want(rows)


def test_no_control_string_survives_in_a_text(spark):
    rows = [(i, 0, "user", x) for i, x in enumerate(HARD)]
    formatted = [r.formatted for r in chat.format_conversations(chat.records_of(conversations(spark, rows))).collect()]
    for text in formatted:
        assert [text.count(m) for m in ("<|im_start|>", "<|im_sep|>", "<|im_end|>", "</s>", "[INST]")] == [1, 1, 1, 0, 0]


def test_layouts_are_chosen_by_paths(spark):
    rows = [
        ({"prompt": "p", "completion": "c"}, "prompt", [("user", "p"), ("assistant", "c")]),
        ({"completion": "c", "prompt": ""}, "prompt", [("user", ""), ("assistant", "c")]),
        ({"instruction": "i", "output": "o"}, "instruction", [("user", "i"), ("assistant", "o")]),
        ({"system": "s", "instruction": "i", "output": "o"}, "instruction", [("system", "s"), ("user", "i"), ("assistant", "o")]),
        ({"conversations": [{"from": "human", "value": "a"}, {"from": "gpt", "value": "b"}]}, "sharegpt", [("user", "a"), ("assistant", "b")]),
        ({"messages": [{"role": "tool", "content": "a"}]}, "messages", [("tool", "a")]),
        ({"messages": [{"role": "user", "content": None}]}, "messages", [("user", "")]),
        ({"messages": []}, "messages", []),
        ({"instruction": "i", "input": "more", "output": "o"}, "instruction", [("user", "i\n\nmore"), ("assistant", "o")]),
        ({"instruction": "i", "input": "", "output": "o", "id": 7, "source": {"name": "s"}}, "instruction", [("user", "i"), ("assistant", "o")]),
        ({"prompt": "p", "response": "r", "score": 0.5}, "response", [("user", "p"), ("assistant", "r")]),
        ({"question": "q", "answer": "a", "tags": ["x"]}, "question", [("user", "q"), ("assistant", "a")]),
        ({"id": "1", "messages": [{"role": "user", "content": "a", "name": "n"}, {"role": "assistant", "content": "b", "tool_calls": []}]}, "messages", [("user", "a"), ("assistant", "b")]),
        ({"messages": [{"role": "user", "content": [{"type": "text", "text": "a"}, {"type": "image", "url": "u"}, {"type": "text", "text": "b"}]}]}, "messages", [("user", "ab")]),
        ({"system": "s", "conversations": [{"from": "human", "value": "a", "weight": 1}]}, "sharegpt", [("system", "s"), ("user", "a")]),
        ({"prompt": "p", "completion": "c", "instruction": "i", "output": "o"}, None, None),
        (["prompt"], None, None),
        ({"other": 1}, None, None),
    ]
    df = spark.createDataFrame([(i, json.dumps(r)) for i, (r, _, _) in enumerate(rows)] + [(99, "no json"), (98, None)], "id long, record string")
    got = {r.id: (r.layout, r.turns and [tuple(t) for t in r.turns]) for r in chat.canonical(df).collect()}
    for i, (_, layout, turns) in enumerate(rows):
        assert got[i] == (layout, turns if turns is None else turns) or (turns == [] and got[i][0] == layout and not got[i][1])
    assert got[99] == got[98] == (None, None)


def test_empty_table(spark):
    assert chat.digests(chat.format_conversations(chat.records_of(conversations(spark, [])))).count() == 0


def test_a_record_too_large_for_variant_is_an_error(spark):
    def formatted(n, tail):
        text = F.expr(f"repeat('a', {n})")
        record = F.concat(F.lit('{"prompt":"'), text, F.lit(f'","completion":"b"{tail}'))
        return chat.canonical(spark.range(1).select(record.alias("record"))).select("layout", F.size("turns").alias("n")).collect()

    assert [tuple(r) for r in formatted(10, "}")] == [("prompt", 2)]
    assert formatted(20_000_000, "")[0].layout is None
    with pytest.raises(Exception, match="too large for a VARIANT"):
        formatted(140_000_000, "}")
