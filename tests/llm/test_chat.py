import hashlib
import random

from messy import rows_of
from pyspark.sql import functions as F

from ascentframe.llm import chat as C

ROWS = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
TRAPS = ["<|turn|>", "<|body|>", "<|end|>", "<\\|end|>", "<\\\\|", "</s>", "<s>", "[INST]", "[/INST]", "[\\INST]", "<", "|", "\\", "[", "é😀", " ", "\n", "$1"]


def formatted(spark, rows):
    frame = spark.createDataFrame(rows, ROWS)
    return C.format_conversations(frame.select("*", F.array(C.text_part(F.col("text"))).alias("parts"), F.lit("clash").alias("one")))


def expected(rows):
    out = []
    for conv in {r[0] for r in rows}:
        turns = sorted(((r[1] is not None, r[1] or 0, r[2] or "", r[3] or "") for r in rows if r[0] == conv))
        learned = "".join(t for *_, role, t in turns if role == "assistant")
        digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
        out.append((conv, len(turns), digest("".join(f"{a}\n{b}\n" for *_, a, b in turns)), len(learned), digest(learned)))
    return sorted(out, key=repr)


def test_messy_rows_and_control_strings(spark):
    rng = random.Random(5)
    text = lambda: "".join(rng.choice(TRAPS) for _ in range(rng.randrange(12)))
    rows = [(k, t, rng.choice(["user", "assistant", "system", text()]), text()) for k in range(40) for t in range(4)]
    rows += [(50, None, None, None), (50, 0, "assistant", None), (50, 0, "assistant", None), (50, 0, "assistant", ""), (None, 1, "user", "x"), (51, 0, "assistant", "long " * 100_000)]
    got = rows_of(C.digests(formatted(spark, rows)), *COLUMNS[:-1])
    assert got == expected(rows)
    assert formatted(spark, []).count() == 0


def test_escapes_are_reversible_and_hide_every_control_string(spark):
    rng = random.Random(6)
    texts = ["".join(rng.choice(TRAPS) for _ in range(rng.randrange(15))) for _ in range(500)]
    frame = spark.createDataFrame([(t,) for t in texts], "text string").select("text", C.escape(F.col("text")).alias("e"))
    for r in frame.select("*", C.unescape(F.col("e")).alias("back")).collect():
        assert r.back == r.text
        assert not any(mark in r.e for mark in ("<|", "</s>", "<s>", "[INST]", "[/INST]"))


def test_typed_parts(spark):
    part = f"conv_id long, turn long, role string, parts array<{C.PART}>"
    image = ("image", None, "s3://a.png", 56, 57, None, None)
    rows = [
        (1, 0, "user", [("text", "see <|image|> ", None, None, None, None, None), image, ("audio", None, "b.wav", None, None, 100, None)]),
        (1, 1, "assistant", [("text", "ok", None, None, None, None, None), ("document", "x", "c.pdf", None, None, None, 3), ("odd", "y", None, None, None, None, None)]),
        (1, 2, "user", None),
    ]
    one = C.format_conversations(spark.createDataFrame(rows, part)).first()
    assert one.formatted == (
        "<|turn|>user<|body|>see <\\|image|> <|image|><|audio|><|end|><|turn|>assistant<|body|>ok<|document|>y<|end|><|turn|>user<|body|><|end|>"
    )
    assert [(a.kind, a.ref, a.tokens, a.segment) for a in one.attachments] == [
        ("image", "s3://a.png", 2 * 3 + 2, 0), ("audio", "b.wav", 3, 0), ("document", "c.pdf", 768, 1),
    ]
    assert one.expanded_tokens == 8 + 3 + 768
    assert [(x.segment, x.start, x.length) for x in one.loss] == [(1, len("<|turn|>assistant<|body|>"), len("ok<|document|>y"))]


def test_control_strings_over_several_parts(spark):
    part = f"conv_id long, turn long, role string, parts array<{C.PART}>"
    text = lambda x: ("text", x, None, None, None, None, None)
    image = ("image", None, "a", 1, 1, None, None)
    rows = [(1, 0, "user", [text("<"), text("|turn|>x"), text("<"), text("|bo"), text("dy|>"), image, text("</"), text("s>"), image, image, text("<"), text(None), text("|end|>")])]
    rows += [(1, 1, "assistant", [text("["), ("odd", "INST]", None, None, None, None, None)])]
    one = C.format_conversations(spark.createDataFrame(rows, part)).select("formatted", C.read_turns(F.col("formatted")).alias("turns"), "loss").first()
    assert one.formatted == (
        "<|turn|>user<|body|><\\|turn|>x<\\|body|><|image|><\\/s><|image|><|image|><\\|end|><|end|><|turn|>assistant<|body|>[\\INST]<|end|>"
    )
    assert [tuple(t) for t in one.turns] == [("user", "<|turn|>x<|body|><|image|></s><|image|><|image|><|end|>"), ("assistant", "[INST]")]
    assert [x.length for x in one.loss] == [len("[\\INST]")]
