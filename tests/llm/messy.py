"""Rows that every operator has to take: NULLs, empty and very long texts, ties, repeated rows, clashing columns."""

from __future__ import annotations

from pyspark.sql import functions as F

LONG = "long words run on and on, " * 8_000
SAME = "the quick brown fox jumps over the lazy dog while twelve more words follow it home"
TEXTS = [
    (1, SAME), (2, SAME), (2, SAME), (3, SAME.upper()), (4, None), (5, ""), (6, " \t\n\v\f\r "), (7, LONG), (None, SAME + " again"),
    (None, None), (8, "x"), (9, "é漢字 😀   \x1c'll don't 's"), (10, "a b\na b\n\na b\n"), (11, "<|endoftext|> </s> [INST]"),
]
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LABELS = "doc_id long, quality int, toxic int"
#: Names that operators use inside, as columns of the input.
CLASHING = ["fp", "words", "bucket", "stats", "score", "kept", "component_id", "least", "root", "ids", "encoded", "trusted", "first", "text_2"]


def docs(spark, rows=TEXTS):
    return spark.createDataFrame([(i, t, None, "s", None if t is None else len(t)) for i, t in rows], DOCS)


def labels(spark, rows=((1, 1, 0), (1, 1, 0), (2, 0, None), (None, 1, 1), (7, None, None), (8, 0, 0), (99, 1, 0))):
    return spark.createDataFrame(list(rows), LABELS)


def clashing(frame):
    for name in CLASHING:
        frame = frame.withColumn(name, F.lit("clash"))
    return frame


def rows_of(frame, *columns):
    return sorted(map(tuple, frame.select(*columns).collect()), key=repr)
