import json
import random

import pytest
from pyspark.sql import functions as F

from metframe.llm import chat

U, A, S = "user", "assistant", "system"
RECORDS = [
    ({"prompt": "p", "response": "r"}, "prompt", [(U, "p"), (A, "r")]),
    ({"system": "s", "prompt": "p", "meta": {"id": 1}}, "prompt", [(S, "s"), (U, "p")]),
    ({"prompt": "p", "completion": "c"}, "completion", [(U, "p"), (A, "c")]),
    ({"instruction": "i", "input": "x", "output": "o"}, "instruction", [(U, "i\n\nx"), (A, "o")]),
    ({"instruction": "i", "input": None, "output": ""}, "instruction", [(U, "i"), (A, "")]),
    ({"question": {"a": 1}, "answer": 3}, "question", [(U, '{"a":1}'), (A, "3")]),
    ({"messages": [{"role": U, "content": "a"}, {"role": "tool"}, {"content": "c", "name": "n"}]}, "messages", [(U, "a"), ("tool", ""), ("", "c")]),
    ({"conversations": [{"from": "human", "value": "h"}, {"from": "gpt", "value": "g"}]}, "conversations", [(U, "h"), (A, "g")]),
    ({"request": {"system": "s", "messages": [{"role": U, "content": "q"}]}, "reply": {"text": "t"}}, "request", [(S, "s"), (U, "q"), (A, "t")]),
    ({"dialog": ["a", "b", "c"]}, "dialog", [(U, "a"), (A, "b"), (U, "c")]),
    ({"messages": []}, None, []), ({"messages": "text"}, None, []), ({"other": 1}, None, []), ({}, None, []), ([1], None, []),
    ({"prompt": "p", "question": "q"}, None, []),
]


def test_layouts(spark):
    rows = [(i, json.dumps(r), "kept") for i, (r, _, _) in enumerate(RECORDS)] + [(90, None, "kept"), (91, "{no json", "kept"), (91, "{no json", "kept")]
    df = spark.createDataFrame(rows, "id int, record string, layout string")
    got = {r.id: (r.layout, [tuple(t) for t in r.turns], r.fingerprint) for r in chat.canonical(df).collect()}
    assert [got[i][:2] for i in range(len(RECORDS))] == [(name, turns) for _, name, turns in RECORDS]
    assert got[90][:2] == got[91][:2] == (None, [])
    assert len({f for _, _, f in got.values()}) == 12  # one for each set of declared paths
    assert chat.canonical(df).count() == len(rows) and chat.canonical(df.where("false")).count() == 0


def test_paths_of_two_shapes_are_refused():
    with pytest.raises(ValueError):
        chat.record_schema(["a", "a.b"])
    with pytest.raises(ValueError):
        chat.record_schema(["a", "a[]"])


@pytest.mark.parametrize("template", [chat.Template(), chat.Template("[INST]", "<s>", "</s>")])
def test_formatted_turns_are_read_back(spark, template):
    rng = random.Random(5)
    bits = [*template.control, "\\", "<", "[", "|", "im_end|>", "INST]", "a", "\n", "é", "\U0001f600", "\x00", "$1", "s>"]
    text = lambda: "".join(rng.choice(bits) for _ in range(rng.randrange(9)))
    rows = [(i, [(rng.choice([U, A, text()]), text()) for _ in range(rng.randrange(5))]) for i in range(400)]
    rows += [(900, None), (901, [(None, None)]), (902, [(A, "x" * 300_000 + "<|")] * 3)]
    df = spark.createDataFrame(rows, "id int, turns array<struct<role:string,text:string>>")
    out = chat.formatted(df, template=template)
    for r in chat.read_back(out.drop("turns"), template).collect():
        turns = [(a or "", b or "") for a, b in dict(rows)[r.id] or []]
        assert [tuple(t) for t in r.turns] == turns and r.learnt == "".join(t for who, t in turns if who == A)
        bare = r.formatted.replace(template.start, "", len(turns)).replace(template.says, "", len(turns)).replace(template.end, "", len(turns))
        assert not [c for c in template.control if c in bare and c not in template.start + template.says + template.end]
        assert r.formatted.count(template.end) == len(turns)


def test_records_of_odd_rows(spark):
    rows = [
        (1, 2, A, "b"), (1, 1, U, "a"), (2, 1, U, None), (2, 1, U, None), (2, None, A, ""), (None, 1, None, "x"), (None, 0, "human", "y"),
        (3, 0, S, "s"), (3, 1, U, "u"), (3, 2, A, "a"), (4, 0, A, "\x00 \"\\ \U0001f600"), (5, 0, U, "long " * 200_000), (5, 1, A, "")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: (r.layout, [tuple(t) for t in r.turns]) for r in chat.canonical(chat.records_of(df)).collect()}
    assert got == {
        1: ("prompt", [(U, "a"), (A, "b")]), 2: ("conversations", [(A, ""), (U, ""), (U, "")]), None: ("messages", [("human", "y"), ("", "x")]),
        3: ("instruction", [(S, "s"), (U, "u"), (A, "a")]), 4: ("conversations", [(A, "\x00 \"\\ \U0001f600")]),
        5: ("prompt", [(U, "long " * 200_000), (A, "")]),
    }
    assert chat.records_of(df.where("false")).count() == 0


def test_only_built_in_functions_run(spark):
    df = spark.createDataFrame([(1, 1, U, "a")], "conv_id long, turn long, role string, text string")
    plan = chat.read_back(chat.formatted(chat.canonical(chat.records_of(df))))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and plan.count("Exchange") == 1
    assert chat.formatted(df.select(F.lit(None).cast(chat.TURNS).alias("turns"))).first().formatted == ""
