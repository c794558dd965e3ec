"""Chat formatting with typed content parts (operator 3).

A message is a list of parts: text, image, audio or document. A visitor flattens the parts in order: texts are escaped,
other parts become placeholders, and each leaves an attachment record with the tokens its placeholder expands to. Control
strings mark turns; inside texts and roles every control string (also those of other templates) is escaped reversibly by
one backslash. DataFrame functions only.

    <|turn|>role<|body|>content<|end|>
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ascentframe.llm.common import let

TURN, BODY, END = "<|turn|>", "<|body|>", "<|end|>"
#: What could be read as a control string: an opening sign, backslashes, and the rest of the string.
CONTROL = r"([<\[])(\\*)(\||/?s>|/?INST\])"
ESCAPED = r"([<\[])\\(\\*)(\||/?s>|/?INST\])"
KINDS = ("image", "audio", "document")
#: An image takes a token for each tile of so many pixels a side and two around; audio one for so many milliseconds;
#: a document so many for each page.
TILE, AUDIO_MS, PAGE_TOKENS = 28, 40, 256
LEARNED_ROLE = "assistant"
PART = "struct<kind:string,text:string,ref:string,width:int,height:int,millis:long,pages:int>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, CONTROL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, "$1$2$3")


def text_part(text: Column) -> Column:
    """One text part; NULL counts as empty."""
    empty = {"ref": "string", "width": "int", "height": "int", "millis": "long", "pages": "int"}
    return F.struct(
        F.lit("text").alias("kind"),
        F.coalesce(text, F.lit("")).alias("text"),
        *[F.lit(None).cast(kind).alias(name) for name, kind in empty.items()],
    )


def placeholder(kind: Column) -> Column:
    return F.concat(F.lit("<|"), kind, F.lit("|>"))


def expanded_tokens(part: Column) -> Column:
    """Tokens that a part's placeholder stands for; 0 for texts, unknown kinds and missing sizes."""
    tiles = lambda side: F.ceil(F.greatest(side, F.lit(0)) / TILE)
    count = (
        F.when(part["kind"] == "image", tiles(part["width"]) * tiles(part["height"]) + 2)
        .when(part["kind"] == "audio", F.ceil(F.greatest(part["millis"], F.lit(0)) / AUDIO_MS))
        .when(part["kind"] == "document", F.greatest(part["pages"], F.lit(0)) * PAGE_TOKENS)
    )
    return F.coalesce(count, F.lit(0)).cast("long")


def _is_attachment(part: Column) -> Column:
    return F.coalesce(part["kind"].isin(*KINDS), F.lit(False))


def _escaped_runs(parts: Column) -> Column:
    """The texts `raw` joined; those between two attachments (their places from 1: `at`) are escaped as one text, since a
    control string may be spread over parts."""
    raw, at = parts["raw"], parts["at"]

    def after(start: Column, k: Column) -> Column:
        end = F.coalesce(F.get(at, k), F.size(raw) + 1)
        run = F.array_join(F.slice(raw, start + 1, end - start - 1), "")
        return F.concat(F.coalesce(F.get(raw, start - 1), F.lit("")), escape(run))

    return F.array_join(F.transform(F.concat(F.array(F.lit(0)), at), after), "")


def visit(parts: Column) -> Column:
    """Flattened content of a message: (content, attachments). Unknown or NULL kinds count as text."""
    known = F.coalesce(parts, F.array().cast(f"array<{PART}>"))
    content = let(
        F.struct(
            F.transform(known, lambda p: F.when(_is_attachment(p), placeholder(p["kind"])).otherwise(F.coalesce(p["text"], F.lit("")))).alias("raw"),
            F.filter(F.transform(known, lambda p, i: F.when(_is_attachment(p), i + 1)), lambda i: i.isNotNull()).alias("at"),
        ),
        _escaped_runs,
    )
    attachments = F.transform(
        F.filter(known, _is_attachment),
        lambda p: F.struct(p["kind"].alias("kind"), p["ref"].alias("ref"), expanded_tokens(p).alias("tokens")),
    )
    return F.struct(content.alias("content"), attachments.alias("attachments"))


def format_conversations(messages: DataFrame) -> DataFrame:
    """One row for each conv_id of `messages` (conv_id, turn, role, parts).

    formatted: the whole text. loss: for each turn to be learned its number in the text (from 0), the code points before
    its content in that turn's segment, and the content's length. attachments: kind, ref, expanded tokens and turn, in
    order. expanded_tokens: their sum. Turns are ordered by turn (NULL first), then role and content, so ties and
    repeated rows have one order; NULL roles are empty; NULL conv_ids form one conversation. Other columns are ignored.

    A conversation becomes one text, so its rows meet in one task by definition; only finished segments are shuffled.
    """
    seen = F.col("seen")
    segments = messages.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), visit(F.col("parts")).alias("seen")
    ).select(
        "conv_id",
        F.struct(
            "turn",
            "role",
            F.concat(F.lit(TURN), escape(F.col("role")), F.lit(BODY), seen["content"], F.lit(END)).alias("segment"),
            F.length(F.concat(F.lit(TURN), escape(F.col("role")), F.lit(BODY))).alias("before"),
            F.length(seen["content"]).alias("length"),
            seen["attachments"].alias("attachments"),
        ).alias("one"),
    )
    learned = F.filter(
        F.transform(
            F.col("turns"),
            lambda t, i: F.struct(
                i.cast("long").alias("segment"), t["before"].cast("long").alias("start"),
                t["length"].cast("long").alias("length"), (t["role"] == LEARNED_ROLE).alias("learned"),
            ),
        ),
        lambda x: x["learned"],
    )
    attached = F.flatten(
        F.transform(
            F.col("turns"), lambda t, i: F.transform(t["attachments"], lambda a: a.withField("segment", i.cast("long")))
        )
    )
    return (
        segments.groupBy("conv_id")
        .agg(F.sort_array(F.collect_list("one")).alias("turns"))
        .select(
            "conv_id",
            F.array_join(F.transform("turns", lambda t: t["segment"]), "").alias("formatted"),
            F.transform(learned, lambda x: x.dropFields("learned")).alias("loss"),
            attached.alias("attachments"),
        )
        .withColumn("expanded_tokens", F.aggregate("attachments", F.lit(0).cast("long"), lambda a, x: a + x["tokens"]))
    )


def segments_of(formatted: Column) -> Column:
    """The segments of a formatted conversation, without their first mark."""
    quoted = TURN.replace("|", r"\|")
    return F.slice(F.split(formatted, quoted), 2, F.greatest(F.size(F.split(formatted, quoted)) - 1, F.lit(0)))


def read_turns(formatted: Column) -> Column:
    """(role, text) of each turn, read back from the formatted text; placeholders stand in the text as they are."""
    body, end = BODY.replace("|", r"\|"), END.replace("|", r"\|")

    def one(segment: Column) -> Column:
        parts = F.split(F.regexp_replace(segment, end + "$", ""), body, 2)
        return F.struct(unescape(F.get(parts, F.lit(0))).alias("role"), unescape(F.get(parts, F.lit(1))).alias("text"))

    return F.transform(segments_of(formatted), one)


def read_learned(formatted: Column, loss: Column) -> Column:
    """The texts under the loss mask, unescaped, in order."""
    gone = len(TURN)  # splitting took the first mark of each segment
    return F.transform(F.array(segments_of(formatted)), lambda s: F.transform(
        loss, lambda x: unescape(F.substring(F.get(s, x["segment"].cast("int")), x["start"].cast("int") + 1 - gone, x["length"].cast("int")))
    ))[0]


def digests(formatted: DataFrame, also: tuple[str, ...] = ()) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256 and formatted_chars, read back from formatted texts.

    `also`: n_attachments, expanded_tokens, attachments_sha256 (kind:ref:tokens:turn of each, with commas).
    """
    text = F.col("formatted")
    told = F.transform("attachments", lambda a: F.concat(
        a["kind"], F.lit(":"), F.coalesce(a["ref"], F.lit("")), F.lit(":"), a["tokens"].cast("string"), F.lit(":"), a["segment"].cast("string")))
    more = {
        "n_attachments": F.size("attachments"), "expanded_tokens": F.col("expanded_tokens"),
        "attachments_sha256": F.sha2(F.array_join(told, ",").cast("binary"), 256),
    }
    return formatted.select(
        "conv_id", text, read_turns(text).alias("turns"), F.array_join(read_learned(text, F.col("loss")), "").alias("learned"),
        *[more[name].alias(name) for name in also],
    ).select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "").cast("binary"), 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2(F.col("learned").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        *also,
    )
