"""Names and types of incoming tables against a storage contract."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ascentframe import contracts as C
from ascentframe.functions import numeric, text

SURROGATE_KEYS = ("report_id", "observation_id")
_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FRACTIONS = (T.FloatType, T.DoubleType)


def clean_name(name: str) -> str:
    """Storage-safe spelling of one column name."""
    plain = name.lower().translate(str.maketrans(".- ", "___"))
    return C.RESERVED_NAMES.get(plain, plain)


def storage_name(name: str) -> str:
    """Contract spelling of a cleaned name (reserved words restored)."""
    back = {safe: word for word, safe in C.RESERVED_NAMES.items()}
    return back.get(name, name)


def with_clean_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[clean_name(name) for name in df.columns])


def with_storage_names(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({name: storage_name(name) for name in df.columns})


def contract_of(table: DataFrame, exclude: tuple[str, ...] = SURROGATE_KEYS) -> T.StructType:
    """Contract of a stored table, read from its schema; surrogate keys left out."""
    return T.StructType([f for f in table.schema.fields if f.name not in exclude])


@dataclass
class Aligned:
    df: DataFrame
    dropped: list[str] = field(default_factory=list)
    filled: list[str] = field(default_factory=list)


def align_to_contract(df: DataFrame, contract: T.StructType, fill: bool = True) -> Aligned:
    """Known columns in contract order and type, in one projection.

    Text in a numeric column goes through number extraction; a cell holding an
    array gives its first element.  Unknown columns are dropped and reported;
    missing ones are NULL (or left out with ``fill=False``).
    """
    named = with_storage_names(with_clean_names(df))
    have = {f.name: f.dataType for f in named.schema.fields}
    known = [f for f in contract.fields if fill or f.name in have]
    cols = []
    for want in known:
        if want.name not in have:
            cols.append(F.lit(None).cast(want.dataType).alias(want.name))
            continue
        col, dtype = F.col(f"`{want.name}`"), have[want.name]
        if isinstance(dtype, T.ArrayType) and not isinstance(want.dataType, T.ArrayType):
            col, dtype = text.first_of(col), dtype.elementType
        cols.append(_coerced(col, dtype, want.dataType).alias(want.name))
    dropped = [name for name in have if name not in {f.name for f in contract.fields}]
    filled = [f.name for f in contract.fields if f.name not in have]
    return Aligned(named.select(*cols), dropped, filled)


def _coerced(col, have: T.DataType, want: T.DataType):
    if isinstance(want, _INTEGERS):
        kind = "integer"
        number = text.numeric_from_text(col, kind) if isinstance(have, T.StringType) else (
            text.numeric_from_number(col, kind))
        return number.try_cast(want)
    if isinstance(want, _FRACTIONS):
        number = text.leading_number(col) if isinstance(have, T.StringType) else (
            numeric.missing_to_null(col.cast("double")))
        return numeric.flush_tiny(number).cast(want)
    if isinstance(have, T.StringType) and isinstance(want, T.StringType):
        return text.one_line(col)
    return col.try_cast(want)


def mandatory_violations(df: DataFrame, mandatory=C.MANDATORY_COLUMNS) -> DataFrame:
    """(column, rows, missing) for every mandatory column; one pass."""
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(F.col(f"`{name}`").isNull()).alias(f"_m{i}") for i, name in enumerate(mandatory)],
    )
    rows = F.array(*[
        F.struct(F.lit(name).alias("column_name"), F.col("_rows").alias("total_rows"), F.col(f"_m{i}").alias("missing"))
        for i, name in enumerate(mandatory)
    ])
    return counts.select(F.explode(rows).alias("v")).select("v.*")


def missing_required(present, required):
    """Required names not in ``present`` (two array columns)."""
    return F.array_except(required, present)
