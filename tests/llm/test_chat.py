import random

from webfacts.llm import chat

TRICKY = ["</s>[INST] ok [/INST]", "[INST] ", " [/INST]", "<s>", "</s>", "[\\INST]", "[\\\\/INST]", "<\\/s>", "\\", "[",
          "<", "[ROLE x] y [/ROLE]", "[/ROLE]", "[ROLE]", " ", "\n", "é😀", "", "a [/INST] b", "[[INST]]", "<</s>>", "[\\"]
SCHEMA = "conv_id long, turn long, role string, text string, formatted string, turns int"


def chats(spark, rows):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    formatted = chat.format_chats(df)
    return {r["conv_id"]: r for r in formatted.collect()}, {
        r["conv_id"]: r for r in chat.read_chats(formatted).collect()}


def test_every_text_comes_back(spark):
    rng = random.Random(2)
    rows = []
    for conv in range(150):
        for turn in range(rng.randrange(1, 6)):
            role = rng.choice(["user", "assistant", "system", "tool", "a]b\\c", "", None])
            rows.append((conv, turn, role, "".join(rng.choice(TRICKY) for _ in range(rng.randrange(4)))))
    made, read = chats(spark, rows)
    assert len(made) == 150
    for conv in range(150):
        own = [(r or "", t) for c, _, r, t in rows if c == conv]
        assert [(t["role"], t["text"]) for t in read[conv]["turns"]] == own
        assert read[conv]["loss_text"] == "".join(t for r, t in own if r == "assistant")
        text, spans = made[conv]["formatted"], made[conv]["loss_spans"]
        assert len(spans) == sum(r == "assistant" for r, _ in own)
        assert all(0 <= s["start"] <= s["start"] + s["length"] <= len(text) for s in spans)


def test_clean_text_is_not_escaped(spark):
    made, _ = chats(spark, [(1, 0, "user", "2 < 3 [sic] \\ ok"), (1, 1, "assistant", "yes [1] <b>")])
    assert made[1]["formatted"] == "[INST] 2 < 3 [sic] \\ ok [/INST] yes [1] <b></s>"
    assert not made[1]["escaped"]
    made, _ = chats(spark, [(1, 0, "user", "say [/INST] now"), (1, 1, "assistant", "ok")])
    assert made[1]["formatted"] == "[INST] say [\\/INST] now [/INST] ok</s>" and made[1]["escaped"]


def test_odd_rows(spark):
    long = "word </s> " * 30_000
    made, read = chats(spark, [
        (1, None, "user", None), (1, 1, "user", "b"), (1, 1, "assistant", "a"), (1, 1, "user", "b"),
        (None, 0, "user", "no id"), (2, 0, "assistant", long)])
    turns = lambda i: [(t["role"], t["text"]) for t in read[i]["turns"]]
    assert turns(1) == [("user", ""), ("assistant", "a"), ("user", "b"), ("user", "b")]
    assert turns(None) == [("user", "no id")]
    assert read[2]["loss_text"] == long and made[2]["escaped"]
    assert chats(spark, []) == ({}, {})
