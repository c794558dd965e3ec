"""Text, number-in-text and map clean-up as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ascentframe import contracts as C

# fixed values: the numbers of an elevation text, and a number at the start of a text
ELEVATION_NUMBER = r"(\d+\.?\d*)"
LEADING_NUMBER = r"^([-+]?[0-9]*\.?[0-9]+(?:[eE][-+]?[0-9]+)?)"
INTEGER_TYPES = ("integer", "bigint", "smallint")


def clean_name(name: Column) -> Column:
    """Storage-safe spelling of a column name held as data."""
    plain = F.translate(F.lower(name), ".- ", "___")
    out = plain
    for word, safe in C.RESERVED_NAMES.items():
        out = F.when(plain == word, F.lit(safe)).otherwise(out)
    return out


def one_line(text: Column) -> Column:
    return F.translate(text, "\n", " ")


def without_nul(text: Column) -> Column:
    """NUL characters dropped, ends trimmed."""
    return F.trim(F.replace(text, F.lit("\x00"), F.lit("")))


def decoded(raw: Column) -> Column:
    """Bytes as clean text; malformed UTF-8 is replaced, not refused."""
    return without_nul(F.decode(raw, "UTF-8"))


def leading_number(text: Column) -> Column:
    """The text as a double, or the number it starts with, or NULL."""
    trimmed = F.trim(text)
    found = F.regexp_extract(trimmed, LEADING_NUMBER, 1)
    number = F.coalesce(trimmed.try_cast("double"), found.try_cast("double"))
    return F.when(~F.isnan(number), number)


def numeric_from_text(text: Column, col_type: str) -> Column:
    """Typed coercion: integers are cut toward zero."""
    number = leading_number(text)
    if col_type in INTEGER_TYPES:
        return number.try_cast("long")
    return number


def numeric_from_number(value: Column, col_type: str) -> Column:
    if col_type in INTEGER_TYPES:
        return value.cast("double").try_cast("long")
    return F.when(~F.isnan(value), value)


def first_of(cell: Column) -> Column:
    """First element of an array-valued cell; NULL if there is none."""
    return F.get(cell, 0)


def annotated_number(text: Column) -> Column:
    """Number in the first blank-separated token, other characters stripped."""
    token = F.split(text, " ", 2)[0]
    return F.regexp_replace(token, r"[^0-9.\-]", "").try_cast("double")


def note(text: Column) -> Column:
    return F.left(text, F.lit(C.NOTE_LIMIT))


def short_error(text: Column) -> Column:
    cut = F.concat(F.left(text, F.lit(C.ERROR_LIMIT - 3)), F.lit("..."))
    return F.when(F.length(text) > C.ERROR_LIMIT, cut).otherwise(text)


def lower_keys(attrs: Column) -> Column:
    """Attribute names folded to lower case; on a clash the later entry stays."""
    entries = F.map_entries(attrs)
    size = F.size(entries)
    folded = F.transform(entries, lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")))

    def is_last(e, i):
        rest = F.slice(folded, i + 2, F.greatest(size - i - 1, F.lit(0)))
        return ~F.exists(rest, lambda later: later["key"] == e["key"])

    return F.map_from_entries(F.filter(folded, is_last))


def jsonable(value: Column, kind: T.DataType) -> Column:
    """A value as JSON attributes write it: times in ISO form (a fraction only if
    there is one), bytes as UTF-8 text, anything else as it is."""
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        whole = F.date_format(value, "yyyy-MM-dd'T'HH:mm:ss")
        micros = F.date_format(value, "SSSSSS")
        return F.when(micros == "000000", whole).otherwise(F.concat(whole, F.lit("."), micros))
    if isinstance(kind, T.BinaryType):
        return F.decode(value, "UTF-8")
    return value


def typed_attributes_json(df: DataFrame, names: Sequence[str]) -> Column:
    """The named columns of ``df`` as one JSON object."""
    return F.to_json(F.struct(*[jsonable(F.col(f"`{n}`"), df.schema[n].dataType).alias(n) for n in names]))


def attributes_json(attrs: Column) -> Column:
    return F.to_json(attrs)


def label_with_code(label: Column, code: Column) -> Column:
    return F.format_string("%s (code %d)", label, code)


def label_of(display: Column) -> Column:
    return F.split_part(display, F.lit(" (code"), F.lit(1))


def label_or_code(label: Column, code: Column) -> Column:
    return F.coalesce(label, F.concat(F.lit("Code "), code.cast("string")))


# -- station table cells --------------------------------------------------------
def station_name(cell: Column) -> Column:
    return F.split_part(F.trim(cell), F.lit(","), F.lit(1))


def degrees(cell: Column) -> Column:
    return F.replace(F.trim(cell), F.lit("°"), F.lit("")).try_cast("double")


def elevation(cell: Column) -> Column:
    """Largest number in the text."""
    plain = F.replace(F.trim(cell), F.lit("m"), F.lit(""))
    numbers = F.regexp_extract_all(plain, F.lit(ELEVATION_NUMBER), F.lit(1))
    return F.array_max(F.transform(numbers, lambda x: x.try_cast("double")))


def strict_integer(cell: Column) -> Column:
    trimmed = F.trim(cell)
    return F.when(trimmed.rlike(r"^[+-]?\d+$"), trimmed.try_cast("int"))
