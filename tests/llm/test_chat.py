import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from llm.conftest import SF
from upkeep.llm import chat
from upkeep.llm.queries import op5_chat

TEXT = st.one_of(st.text(max_size=30), st.lists(st.sampled_from([*chat.CONTROLS, "\\", "<", "[", "s>", " ", "\n", "a", "/INST]", "<|none|>", "\\|none|>"]), max_size=8).map("".join))


@settings(max_examples=500, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.sampled_from(["user", "assistant", "system", None, ""]), TEXT), TEXT), max_size=6))
def test_formatted_turns_read_back(turns):
    text, spans, _ = chat.format_turns([(r, [{"kind": "text", "text": t}]) for r, t in turns])
    assert chat.read_turns(text) == turns
    assert [chat.unescape(text[a:b]) for a, b in spans] == [t for r, t in turns if r == "assistant"]
    assert all(c not in chat.escape(t) for _, t in turns for c in chat.CONTROLS)


def digest(rows):
    whole = "".join(f"{r or ''}\n{t or ''}\n" for r, t in rows)
    loss = "".join(t or "" for r, t in rows if r == "assistant")
    return len(rows), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()


def test_whole_table_against_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]
    want = {}
    for c, _, role, text in sorted(rows, key=lambda x: (x[0], x[1])):
        want.setdefault(c, []).append((role, text))
    got = {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in op5_chat(spark, SF).collect()}
    assert got == {c: digest(v) for c, v in want.items()}


def test_parts_and_odd_rows(spark):
    part = lambda kind, **x: {"kind": kind, "text": None, "ref": None, "width": None, "height": None, "seconds": None, "pages": None, **x}
    rows = [(1, 0, "user", [part("text", text="see "), part("image", ref="a.png", width=700, height=300), part("audio", ref="b.wav", seconds=2.0)], "x"),
            (1, 1, "assistant", [part("document", ref="c.pdf", pages=3), part("text", text="done <s>")], "x"), (2, None, None, None, "x"), (None, 0, "system", [part("video", ref="d")], "x")]
    df = spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts {chat._PARTS}, formatted string")
    got = {r["conv_id"]: r for r in chat.format_conversations(df).collect()}
    assert [(a["kind"], a["ref"], a["tokens"]) for a in got[1]["attachments"]] == [("image", "a.png", 3 * 144), ("audio", "b.wav", 50), ("document", "c.pdf", 1800)]
    assert got[1]["attachment_tokens"] == 432 + 50 + 1800
    turns = chat.read_turns(got[1]["formatted"])
    assert turns[0][1].startswith("see <|part|>image:0:432<|/part|><|part|>audio:1:50") and turns[1][1].endswith("done <s>")
    assert chat.read_turns(got[2]["formatted"]) == [(None, "")] and got[None]["attachments"][0]["tokens"] == 0
    assert chat.format_conversations(df.where("false")).count() == 0


def test_repeated_rows_and_long_texts(spark):
    rows = [(1, 0, "user", "same"), (1, 0, "user", "same"), (1, 1, "assistant", "long " * 100_000), (1, None, "user", None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = chat.digests(chat.format_conversations(chat.text_parts(df))).first()
    assert tuple(got)[1:5] == digest([("user", None), ("user", "same"), ("user", "same"), ("assistant", "long " * 100_000)])
    assert df.select(F.count("*")).first()[0] == got["n_turns"]
