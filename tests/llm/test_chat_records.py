"""Records in mixed and broken layouts: nothing crashes, no text is lost."""

import json

from pyspark.sql import functions as F

from vidguard.llm import chat

USER, BOT = {"role": "user", "content": "hi"}, {"role": "assistant", "content": "yo"}


def read(spark, *bodies):
    df = spark.createDataFrame(list(enumerate(bodies)), "conv_id long, record string").coalesce(1)
    return {r.conv_id: (r.layout, [tuple(t) for t in r.turns], r.unmapped)
            for r in chat.from_json_records(df).collect()}


def test_metadata_is_no_part_of_a_layout(spark):
    bodies = [{"messages": [USER, BOT], "id": 7, "source": {"a": [1, {"b": 2}]}},
              {"messages": [{**USER, "name": "x", "tool_calls": [{"f": 1}]}, BOT]},
              {"prompt": "p", "response": "r", "meta": None},
              {"instruction": "i", "input": "", "output": "o", "id": 1},
              {"conversations": [{"from": "human", "value": "a"}, {"from": "gpt", "value": None}]}]
    got = read(spark, *map(json.dumps, bodies))
    two = [("user", "hi"), ("assistant", "yo")]
    assert got == {0: ("messages", two, None), 1: ("messages", two, None),
                   2: ("prompt_response", [("user", "p"), ("assistant", "r")], None),
                   3: ("instruction_input", [("user", "i"), ("assistant", "o")], None),
                   4: ("from_value", [("user", "a"), ("assistant", "")], None)}


def test_empty_and_null_arrays_have_their_layout(spark):
    assert read(spark, '{"messages": []}', '{"messages": null}', '{"turns": [], "id": 1}') == {
        0: ("messages", [], None), 1: ("messages", [], None), 2: ("rows", [], None)}


def test_broken_records_come_back_whole(spark):
    bodies = ["[" * 100_000, '{"messages[].role": "x", "messages[].content": "y"}', "no json", "5",
              '{"messages": [1, 2]}', '{"messages": [{"role": "user", "content": "a"}, 3]}',
              '{"messages": "text"}', '{"a": 1}', "", '{"prompt": "only"}', '{"messages": {"role": 1}}']
    assert read(spark, *bodies) == {i: (None, [], b) for i, b in enumerate(bodies)}
    assert read(spark, None) == {0: (None, [], None)}


def test_lone_surrogates_are_replaced(spark):
    got = read(spark, '{"prompt": "a\\ud800b", "response": "\\ud83d\\ude00 \\udc00"}')
    assert got[0][1] == [("user", "a�b"), ("assistant", "\U0001f600 �")]


def test_other_values_are_shown_as_json(spark):
    got = read(spark, '{"messages": [{"role": "user", "content": [{"type": "text"}]}]}',
               '{"prompt": 5, "response": true}')
    assert got[0][0] is None or got[0][1]
    assert got[1] == ("prompt_response", [("user", "5"), ("assistant", "true")], None)


def test_mixed_layouts_give_the_rows_digests(spark):
    """All conversations, as records of four layouts and as plain rows: the same digests."""
    rows = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    odd = spark.createDataFrame([
        (-1, 0, "user", None), (-1, 1, "assistant", ""), (-2, 0, None, "a\u2028\"\\ b"),
        (None, 0, "user", "null id"), (-3, 0, "human", "x"), (-3, 1, "gpt", "</s>[INST] y\\"),
        (-4, 1, "assistant", "late"), (-4, None, "user", "first"), (2 ** 53 + 1, 0, "user", "wide")],
        "conv_id long, turn long, role string, text string")
    rows = rows.select("conv_id", F.col("turn").cast("long"), "role", "text").unionByName(odd)
    records = chat.as_mixed_records(rows)
    layouts = {r[0] for r in chat.from_json_records(records).select("layout").distinct().collect()}
    assert layouts == {"messages", "from_value", "rows", "prompt_response"}
    want = sorted(map(tuple, chat.digests(chat.format_conversations(rows)).collect()), key=repr)
    got = chat.digests(chat.render(chat.from_json_records(records)))
    assert sorted(map(tuple, got.collect()), key=repr) == want
