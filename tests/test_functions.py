import math

import pytest
from pyspark.sql import functions as F

from ascentframe.functions import naming, numeric, text, times
from ascentframe.operators import schema


def one(spark, col):
    return spark.range(1).select(col.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "value, expected",
    [("123.45", 123.45), ("12.5 m", 12.5), ("-3e2x", -300.0), ("abc", None), ("", None), ("  7 ", 7.0), (None, None)],
)
def test_number_from_text(spark, value, expected):
    assert one(spark, text.numeric_from_text(F.lit(value).cast("string"), "real")) == expected


@pytest.mark.parametrize("value, expected", [("123.45", 123), ("7 hPa", 7), ("-1.9", -1), ("abc", None)])
def test_integer_from_text(spark, value, expected):
    assert one(spark, text.numeric_from_text(F.lit(value), "integer")) == expected


def test_integer_from_number_cuts_toward_zero(spark):
    assert one(spark, text.numeric_from_number(F.lit(-1.9), "integer")) == -1
    assert one(spark, text.numeric_from_number(F.lit(float("nan")), "real")) is None


@pytest.mark.parametrize("value, expected", [(1e-39, 0.0), (-1e-39, 0.0), (0.0, 0.0), (2e-38, 2e-38)])
def test_tiny_values_become_zero(spark, value, expected):
    assert one(spark, numeric.flush_tiny(F.lit(value))) == expected


def test_notes_are_cut(spark):
    assert len(one(spark, text.note(F.lit("n" * 300)))) == 255
    assert one(spark, text.short_error(F.lit("e" * 201))) == "e" * 197 + "..."
    assert one(spark, text.short_error(F.lit("e" * 200))) == "e" * 200


def test_station_cells(spark):
    assert one(spark, text.station_name(F.lit(" Lauder, NZ"))) == "Lauder"
    assert one(spark, text.degrees(F.lit("-45.05°"))) == -45.05
    assert one(spark, text.degrees(F.lit("?"))) is None
    assert one(spark, text.elevation(F.lit("98 m / 112 m"))) == 112.0
    assert one(spark, text.strict_integer(F.lit("0-20000-0-10393"))) is None
    assert one(spark, text.strict_integer(F.lit(" 94326 "))) == 94326


def test_text_clean_up(spark):
    assert one(spark, text.one_line(F.lit("a\nb"))) == "a b"
    assert one(spark, text.decoded(F.lit(bytearray(b"\x00 Ny-\xc3\x85lesund\x00")))) == "Ny-Ålesund"
    assert one(spark, text.annotated_number(F.lit("12.5hPa at top"))) == 12.5
    assert one(spark, text.annotated_number(F.lit("2024-01-01 00:00"))) is None
    assert one(spark, text.label_of(text.label_with_code(F.lit("pressure"), F.lit(142)))) == "pressure"
    assert one(spark, text.label_or_code(F.lit(None).cast("string"), F.lit(7))) == "Code 7"


def test_lower_keys_keeps_the_later_of_two(spark):
    attrs = F.create_map(F.lit("A.B"), F.lit("1"), F.lit("a.b"), F.lit("2"), F.lit("C"), F.lit("3"))
    assert one(spark, text.lower_keys(attrs)) == {"a.b": "2", "c": "3"}


@pytest.mark.parametrize(
    "name, clean",
    [("Comment", "cmt"), ("g.Product.ID", "g_product_id"), ("wind-speed max", "wind_speed_max"), ("User", "usr")],
)
def test_names(spark, name, clean):
    assert schema.clean_name(name) == clean
    assert one(spark, text.clean_name(F.lit(name))) == clean


def test_timestamps(spark):
    def stamp(value):
        got = one(spark, times.lenient_timestamp(F.lit(value)))
        return None if got is None else str(got)

    assert stamp("20240528T212000") == "2024-05-28 21:20:00"
    assert stamp("2024-05-28T21:20:00Z") == "2024-05-28 21:20:00"
    assert stamp("2024-05-28 21:20:00") == "2024-05-28 21:20:00"
    assert stamp("soon") is None
    assert stamp("") is None


def test_month_end_rolls_over_december(spark):
    assert str(one(spark, times.month_end(F.to_date(F.lit("2020-12-15"))))) == "2021-01-01"


def test_sentinels(spark):
    null = F.lit(None).cast("double")
    assert one(spark, numeric.encoded(null, "int64")) == -(2**63)
    assert one(spark, numeric.encoded(null, "uint8")) == 255
    assert one(spark, numeric.encoded(null, "uint16")) == 65535
    assert one(spark, numeric.encoded(null, "int32")) == -(2**31)
    assert math.isnan(one(spark, numeric.encoded(null, "float32")))
    assert one(spark, numeric.encoded(null, "text")) == ""


def test_either_dialect_takes_what_exists(spark):
    df = spark.sql("SELECT CAST('NaN' AS double) AS a, 2.0D AS b, CAST(NULL AS string) AS t, 'x' AS s")
    have = df.columns
    row = df.select(
        numeric.either_number(have, "a", "b").alias("n"),
        numeric.either_number(have, "a", None).alias("nothing"),
        numeric.either_number(have, "zz", None).alias("absent"),
        numeric.either_number(have, "b", "a", {"b": (100.0, 1.0)}).alias("scaled"),
        numeric.either_text(have, "t", "s").alias("w"),
        numeric.either_text(have, "t", "zz").alias("blank"),
    ).first()
    assert row.asDict() == {"n": 2.0, "nothing": None, "absent": None, "scaled": 201.0, "w": "x", "blank": ""}


NAMES = [
    ("LIN-RS-01_2_RS41-GDP_001_20260323T060000_1-000-001_AI1163482_rev001.jar",
     ("LIN", "2_", "RS41-GDP", "001", "20260323T060000", "1-000-001", "AI1163482", "001", 1, 1)),
    ("LIN-RS-01_2_RS92-GDP_002_20240528T212000_1-002-001_AI1021532.jar",
     ("LIN", "2_", "RS92-GDP", "002", "20240528T212000", "1-002-001", "AI1021532", None, 1, 0)),
    ("SYO-RS-01_2_RS-11G-GDP_001_20250227T120000_1-000-001_AI1131479_rev001.jar",
     ("SYO", "2_", "RS-11G-GDP", "001", "20250227T120000", "1-000-001", "AI1131479", "001", 1, 1)),
    ("SYO-RS-01_2_IMS-100-GDP_002_20260322T000000_1-000-001_AI1163461_rev001.jar",
     ("SYO", "2_", "IMS-100-GDP", "002", "20260322T000000", "1-000-001", "AI1163461", "001", 1, 1)),
]


@pytest.mark.parametrize("name, fields", NAMES)
def test_archive_names(spark, name, fields):
    df = spark.createDataFrame([(f"/data/LIN-RS-02/{name}",)], "path string")
    row = naming.parse_archive_names(df).first()
    got = tuple(row[n] for n in ("station", "extra", "product", "version", "datetime", "group", "id", "rev",
                                 "group_no", "rev_no"))
    assert row["matches"] and got == fields
    assert df.select(naming.folder_priority(F.col("path")).alias("p")).first()["p"] == 1


def test_archive_name_that_does_not_match(spark):
    df = spark.createDataFrame([("/d/readme.txt",), ("/d/lin-RS-01_x.jar",)], "path string")
    assert [r["matches"] for r in naming.parse_archive_names(df).collect()] == [False, False]


def test_align_reports_what_it_drops_and_fills(spark):
    from pyspark.sql import types as T

    contract = T.StructType(
        [T.StructField("comment", T.StringType()), T.StructField("press", T.FloatType()),
         T.StructField("n", T.IntegerType()), T.StructField("absent", T.DoubleType())]
    )
    df = spark.createDataFrame([("1000.5 hPa", "two\nlines", [7.9, 1.0], 1)],
                               "Press string, Comment string, N array<double>, other int")
    aligned = schema.align_to_contract(df, contract)
    assert aligned.dropped == ["other"] and aligned.filled == ["absent"]
    assert tuple(aligned.df.first()) == ("two lines", 1000.5, 7, None)
    assert aligned.df.dtypes == [("comment", "string"), ("press", "float"), ("n", "int"), ("absent", "double")]
