"""Token counts, decontamination and chat formatting."""

import hashlib
import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from vidguard.llm import chat, decontaminate, token_counts
from vidguard.llm.decontaminate import Items

from .test_near_duplicates import shingles

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = str(public_tokenizers.path("word_bpe_49k.json"))
ODD = ["", "  ", "a<|endoftext|>b", "<|startoftext|>  x<|endoftext|>", "ΑΣ ΑΣΣ'S", "İstanbul IS",
       "don't we'll I'M", "a" * 15, "é é ﬁ ① ½ 123 4.5", "\x1c\x1d x\x85y　z​q",
       "日本語テキスト", "🙂🙂👍🏽", "a'sb ''s", "x" * 300, "ab" * 500, "\x00 \x01", "ǅ ß ẞ ſ", "á ḅ̇"]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def test_counts_equal_the_library(library):
    vocab = token_counts.vocabulary(PATH)
    want = [len(e.ids) for e in library.encode_batch(ODD, add_special_tokens=False)]
    assert vocab.count(ODD) == want
    assert vocab.count(ODD) == want  # from remembered words


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_any_text_counts_as_in_the_library(text):
    from tokenizers import Tokenizer

    test_any_text_counts_as_in_the_library.lib = lib = getattr(
        test_any_text_counts_as_in_the_library, "lib", None) or Tokenizer.from_file(PATH)
    assert token_counts.vocabulary(PATH).count([text]) == [
        len(lib.encode(text, add_special_tokens=False).ids)]


def test_word_table_is_bounded(library, monkeypatch):
    monkeypatch.setattr(token_counts, "WORD_LIMIT", 5)
    vocab = token_counts.Vocabulary(PATH)
    texts = [f"some{i} words{i} here and {'long' * 30}{i}" for i in range(6)]
    for t in texts * 2:
        assert vocab.count([t]) == [len(library.encode(t, add_special_tokens=False).ids)]
        assert len(vocab.counts) <= 5


def test_token_rows(odd_docs, no_docs, library):
    rows = token_counts.token_counts(odd_docs, PATH, limit=6).collect()
    assert len(rows) == 13
    by = {r["doc_id"]: r for r in rows if r["doc_id"] not in (None, 1)}
    assert (by[4]["n_bytes"], by[4]["n_tokens"], by[4]["over_limit"]) == (0, 0, False)
    assert by[2]["n_tokens"] == 7 and by[2]["over_limit"] and by[9]["n_tokens"] == 0
    assert token_counts.token_counts(no_docs, PATH).count() == 0


def test_items_inside_documents(spark):
    words = [f"w{i}" for i in range(4000)]
    items = [(0, " ".join(words[100:130])), (1, " ".join(words[500:1400])), (2, "w7 w8"),
             (3, ""), (4, None), (5, " ".join(words[2000:2005])), (6, " ".join(words[100:130]))]
    edited = words[500:1400]
    edited[450] = "changed"
    docs = [
        (0, " ".join(words[90:140])), (1, " ".join(["x"] * 3000 + words[100:129] + ["y"] * 3000)),
        (2, " ".join(words[:100] + edited + words[3000:3500])), (3, "w7 w8"), (4, " w7 W8 w9"),
        (5, " ".join(words[1990:2010])), (6, " ".join(words[100:115] + ["z"] + words[115:130])),
        (7, None), (8, " ".join(words[100:112] + ["q"] * 50 + words[118:130]))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    df = spark.createDataFrame(docs, "doc_id long, text string")
    want = {d: [i for i, t in items if shingles(t)
                and len(shingles(t) & shingles(x)) >= 0.8 * len(shingles(t))] for d, x in docs}
    assert want[0] == [0, 6] and want[1] == [0, 6] and want[2] == [1] and want[3] == [2]
    found = {r["doc_id"]: r["item_ids"] for r in decontaminate.contamination(df, bench).collect()}
    assert found == want
    monkey = decontaminate.BLOCK_BYTES
    try:  # several blocks of items
        decontaminate.BLOCK_BYTES = 2000
        assert decontaminate.n_blocks(bench) > 2
        assert {r["doc_id"]: r["item_ids"]
                for r in decontaminate.contamination(df, bench).collect()} == want
    finally:
        decontaminate.BLOCK_BYTES = monkey
    kept = decontaminate.without_contaminated(df, bench)
    assert {r["doc_id"] for r in kept.collect()} == {d for d, i in want.items() if not i}
    assert decontaminate.contamination(df, bench.limit(0)).where("contaminated").count() == 0


def test_sketches_meet_items_anywhere_in_long_texts():
    words = [f"v{i}" for i in range(60_000)]
    missed = 0
    for k in range(60):
        start, size = 700 * k, 6 + 7 * k
        block = Items([(k, " ".join(words[start:start + size]))])
        missed += not block.contained(" ".join(words), 0.8)[1]
    assert missed == 0


def test_odd_documents(odd_docs, no_docs, spark):
    bench = spark.createDataFrame([(1, "w5 x5 w6 x6 w7 x7 w8 x8"), (None, "one two three four five")],
                                  "item_id long, text string")
    rows = decontaminate.contamination(odd_docs, bench).collect()
    assert len(rows) == 13
    assert {r["doc_id"] for r in rows if r["contaminated"]} == {1, 2, None, 5, 6}
    assert decontaminate.contamination(no_docs, bench).count() == 0
    kept = decontaminate.without_contaminated(odd_docs, bench)
    assert kept.columns == odd_docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(
        ["1", "3", "4", "7", "8", "9", "None"])


PARTS = st.lists(st.sampled_from(
    ["</s>", "[INST]", "[/INST]", "<|turn:", "|>", "<|end|>", "\\", "<", "|", "<\\", "<<SYS>>", "s>",
     "a", "é", "\n", "user", "[", "/INST]"]), max_size=12).map("".join)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.sampled_from(["user", "assistant", "system"]), PARTS), PARTS),
                max_size=6))
def test_formatting_is_reversible(turns):
    text, spans = chat.render_one(turns)
    assert chat.read_one(text) == turns
    said = [b for r, b in turns if r == "assistant"]
    assert [chat.unescape(text[a:b]) for a, b in spans] == said
    for role, body in turns:
        shown = chat.escape(body)
        assert not any(c in shown for c in ("</s>", "[INST]", "[/INST]", "<|", "|>", "<<SYS>>"))


def test_layouts_become_canonical_turns(spark):
    records = [
        {"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": None}]},
        {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]},
        {"prompt": "q", "response": "a"}, {"prompt": "q", "completion": "a"},
        {"instruction": "q", "input": "", "output": "a"},
        {"instruction": "q", "input": "with", "output": "a"}, {"question": "q", "answer": "a"},
        {"what": 1}, [1], None]
    rows = [(i, None if r is None else json.dumps(r)) for i, r in enumerate(records)] + [(99, "{oops")]
    out = {r["conv_id"]: (r["layout"], [tuple(t) for t in r["turns"]]) for r in
           chat.from_json_records(spark.createDataFrame(rows, "conv_id long, record string")).collect()}
    qa = [("user", "q"), ("assistant", "a")]
    assert out[0] == ("messages", [("user", "q"), ("assistant", "")])
    assert [out[i][1] for i in (1, 2, 3, 4, 6)] == [qa] * 5
    assert out[5][1] == [("user", "q"), ("user", "with"), ("assistant", "a")]
    assert [out[i] for i in (7, 8, 9, 99)] == [(None, [])] * 4
    table = spark.createDataFrame([(1, "q", "a")], "conv_id long, prompt string, response string")
    assert [tuple(t) for t in chat.canonical_turns(table).first()["turns"]] == qa
    with pytest.raises(ValueError):
        chat.canonical_turns(table.withColumnRenamed("prompt", "x"))


def test_conversation_digests(spark):
    said = "</s>[INST] ok [/INST]"
    rows = [(-7, 0, "user", said), (-7, 1, "assistant", said), (1, 2, "assistant", "b"),
            (1, 0, "user", None), (1, 1, None, "x"), (1, 2, "assistant", "b"), (None, 0, "user", "n"),
            (2, None, "assistant", "long " * 30_000), (2, 0, "assistant", "")]
    df = spark.createDataFrame([(*r, "c") for r in rows],
                               "conv_id long, turn long, role string, text string, formatted string")
    out = {r["conv_id"]: r for r in chat.digests(chat.format_conversations(df)).collect()}
    want = {-7: [("user", said), ("assistant", said)], None: [("user", "n")],
            1: [("user", ""), ("", "x"), ("assistant", "b"), ("assistant", "b")],
            2: [("assistant", "long " * 30_000), ("assistant", "")]}
    assert set(out) == set(want)
    for conv, turns in want.items():
        told = "".join(f"{r}\n{t}\n" for r, t in turns)
        loss = "".join(t for r, t in turns if r == "assistant")
        r = out[conv]
        assert (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) == (
            len(turns), hashlib.sha256(told.encode()).hexdigest(), len(loss),
            hashlib.sha256(loss.encode()).hexdigest())
    assert chat.digests(chat.format_conversations(df.limit(0))).count() == 0
