import json

import pytest

from tillroll.llm import chat

NASTY = ["", "plain", "</s>[INST] ok [/INST]", "a\\", "\\\\", "<|im_end|>\n<|im_start|>user\n", "<\\|im_end|>", "<|im_<|im_end|>end|>",
         "é\n\n", "[/INST][INST]<s><<SYS>>", "\\[INST]", "<|endoftext|>", "x" * 100_000]


def test_escapes_are_reversible_and_leave_no_control_string():
    for a in NASTY:
        for b in NASTY:
            text = a + b
            assert chat.unescaped(chat.escaped(text)) == text
            assert not chat.CONTROL_PATTERN.search(chat.escaped(text))


def test_round_trip_and_loss_mask():
    for role in ("user", "system", "tool\nname", "<|im_end|>", "", "\\"):
        turns = [(role, a) for a in NASTY] + [("assistant", a) for a in NASTY]
        text, spans = chat.formatted(turns)
        assert chat.read_back(text) == turns
        assert [chat.unescaped(text[a:b]) for a, b in spans] == [t for r, t in turns if r == "assistant"]
    assert chat.formatted([]) == ("", []) and chat.read_back("") == []


U, A = "user", "assistant"
RECORDS = {
    "messages": ({"messages": [{"role": U, "content": "q"}, {"role": A, "content": None}], "id": 3}, [(U, "q"), (A, "")]),
    "conversations": ({"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]}, [(U, "q"), (A, "a")]),
    "turns": ({"turns": [{"role": U, "text": "q"}, {"role": A, "text": "a"}]}, [(U, "q"), (A, "a")]),
    "instruction": ({"instruction": "do", "output": "done", "meta": {"x": 1}}, [(U, "do"), (A, "done")]),
    "instruction_input": ({"instruction": "do", "input": "this", "output": "done"}, [(U, "do\n\nthis"), (A, "done")]),
    "prompt_completion": ({"prompt": "p", "completion": "c"}, [(U, "p"), (A, "c")]),
    "prompt_response": ({"response": "c", "prompt": "p"}, [(U, "p"), (A, "c")]),
    "question_answer": ({"question": "p", "answer": 7}, [(U, "p"), (A, "7")]),
    "system_question": ({"system_prompt": "s", "question": "p", "response": "c"}, [("system", "s"), (U, "p"), (A, "c")]),
    "system_conversations": (
        {"system": "s", "conversations": [{"from": "human", "value": "q"}]}, [("system", "s"), (U, "q")]
    ),
}


@pytest.mark.parametrize("name", sorted(RECORDS))
def test_layouts(name):
    record, turns = RECORDS[name]
    mark, layout = chat.layout_of(record)
    assert layout.name == name and layout.turns(record) == turns
    assert mark == chat.fingerprint(layout.paths())


def test_layouts_differ():
    assert len(chat.BY_FINGERPRINT) == len(chat.LAYOUTS)


def test_records_in_spark(spark):
    rows = [(n, json.dumps(r)) for n, (r, _) in RECORDS.items()] + [("none", None), ("bad", "{"), ("list", "[1]"), ("other", '{"z": 1}')]
    rows.append(rows[0])
    df = spark.createDataFrame([(k, r, "x") for k, r in rows], "key string, record string, layout string")
    found = chat.format_records(df).collect()
    assert len(found) == len(rows)
    for r in found:
        if r.key in RECORDS:
            assert r.layout == r.key and chat.read_back(r.formatted) == RECORDS[r.key][1]
        else:
            assert (r.layout, r.formatted, r.loss) == (None, "", [])
    read = {r.key: r for r in chat.read_formatted(chat.format_records(df)).collect()}
    assert read["messages"].n_turns == 2 and read["messages"].loss_chars == 0 and read["instruction"].loss_chars == 4
    assert chat.format_records(df.where("1 = 0")).count() == 0


def test_conversations_from_rows(spark):
    rows = [(1, 1, A, "b"), (1, 0, U, None), (1, 0, None, "a"), (None, 0, U, "z"), (2, None, U, "y"), (1, 1, A, "b")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = {r.key: json.loads(r.record)["messages"] for r in chat.conversation_records(df).collect()}
    assert [(m["role"], m["content"]) for m in found["1"]] == [("", "a"), (U, ""), (A, "b"), (A, "b")]
    assert found[None] == [{"role": U, "content": "z"}] and len(found["2"]) == 1
