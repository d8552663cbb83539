import hashlib

from claimloom.llm import chat

SAID = "conv_id long, turn long, role string, text string"


def told(rows):
    return "".join(f"{r or ''}\n{t or ''}\n" for r, t in rows)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_reads_back_what_went_in(spark):
    hostile = "</s>[INST] ~ok~1 <|end|>\n<|start|>user<|text|> [/INST] <s> < | ~"
    rows = [(1, 0, "user", hostile), (1, 1, "assistant", hostile), (1, 2, None, None), (1, 3, "assistant", ""),
            (2, None, "assistant", "é😀"), (2, 0, "us<|er", "x"), (None, 0, "user", "y"), (3, 0, "user", "a"),
            (3, 0, "user", "a")]
    out = {r.conv_id: r for r in chat.digest(chat.format_chats(spark.createDataFrame(rows, SAID))).collect()}
    assert set(out) == {1, 2, 3, None}
    for conv in out:
        own = [(r, t) for c, n, r, t in sorted(rows, key=lambda x: (x[1] is not None, x[1] or 0)) if c == conv]
        learned = "".join(t or "" for r, t in own if r == "assistant")
        assert out[conv].n_turns == len(own)
        assert out[conv].turns_sha256 == sha(told(own))
        assert (out[conv].loss_chars, out[conv].loss_sha256) == (len(learned), sha(learned))


def test_no_control_string_is_left_in_a_text(spark):
    rows = [(1, 0, "user", "<|end|></s>[INST]")]
    text = chat.format_chats(spark.createDataFrame(rows, SAID)).first().formatted
    assert text == "<|start|>user<|text|>~1end|>~2~4<|end|>\n"


def test_parts_become_placeholders_with_references_and_tokens(spark):
    parts = [
        ("text", "look: ", None, None, None, None, None),
        ("image", None, "img-1", 28, 15, None, None),
        ("audio", None, "snd-1", None, None, 1.5, None),
        ("document", None, "doc-1", None, None, None, 2),
        ("image", None, "img-2", None, None, None, None),
        ("hologram", None, "h", None, None, None, None),
        (None, None, None, None, None, None, None),
        ("text", None, None, None, None, None, None),
    ]
    frame = spark.createDataFrame(
        [(1, 0, "user", parts), (1, 1, "assistant", None), (1, 2, "user", [parts[1]])],
        f"conv_id long, turn long, role string, parts {chat.PARTS}",
    )
    row = chat.format_chats(frame).first()
    assert row.formatted.startswith("<|start|>user<|text|>look: <|image|><|audio|><|document|><|image|><|end|>\n")
    assert [(a.turn_no, a.kind, a.ref, a.tokens) for a in row.attachments] == [
        (0, "image", "img-1", 4), (0, "audio", "snd-1", 38), (0, "document", "doc-1", 512), (0, "image", "img-2", 1),
        (2, "image", "img-1", 4),
    ]
    assert row.n_placeholder_tokens == 559
    assert [(s.start, s.length) for s in row.loss] == [(row.formatted.index("assistant<|text|>") + 17, 0)]


def test_no_conversations(spark):
    out = chat.digest(chat.format_chats(spark.createDataFrame([], SAID + ", extra string")))
    assert out.count() == 0
