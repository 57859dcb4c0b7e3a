"""Lossless text codecs of an export package: every cell as text, and back.

A codec is a pair of column expressions. ``encode`` gives null for null and
otherwise one spelling for each value; ``decode`` reads nothing but that
spelling, so a cell that does not come back equal is a fault of the package.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DataType, DateType, DecimalType, IntegerType, LongType, ShortType, StringType, TimestampNTZType, TimestampType

_WHOLE = r"^(0|-?[1-9][0-9]*)$"
_TIME = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def _number(kind: str) -> tuple[Callable, Callable]:
    return lambda c: c.cast("string"), lambda c: F.when(c.rlike(_WHOLE), c.try_cast(kind))


def _decimal(precision: int, scale: int) -> tuple[Callable, Callable]:
    kind = f"decimal({precision},{scale})"
    spelled = rf"^-?(0|[1-9][0-9]*)\.[0-9]{{{scale}}}$" if scale else _WHOLE
    return lambda c: c.cast(kind).cast("string"), lambda c: F.when(c.rlike(spelled), c.try_cast(kind))


def codec(kind: DataType) -> tuple[str, Callable[[Column], Column], Callable[[Column], Column]]:
    """``(name, encode, decode)`` for a type; ValueError for one that has no lossless text."""
    if isinstance(kind, StringType):
        return "text", lambda c: c, lambda c: c
    if isinstance(kind, ShortType):
        return "int16", *_number("smallint")
    if isinstance(kind, IntegerType):
        return "int32", *_number("int")
    if isinstance(kind, LongType):
        return "int64", *_number("bigint")
    if isinstance(kind, BooleanType):
        return "bool", lambda c: c.cast("string"), lambda c: F.when(c.isin("true", "false"), c == "true")
    if isinstance(kind, DateType):
        return "date", lambda c: F.date_format(c, "yyyy-MM-dd"), lambda c: F.when(c.rlike(r"^\d{4}-\d{2}-\d{2}$"), c.try_cast("date"))
    if isinstance(kind, DecimalType):
        return "decimal", *_decimal(kind.precision, kind.scale)
    if isinstance(kind, TimestampNTZType):
        return "wall-clock-us", lambda c: F.date_format(c, _TIME), lambda c: F.when(c.rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}\.\d{6}$"), c.try_cast("timestamp_ntz"))
    if isinstance(kind, TimestampType):
        # microseconds since the epoch do not depend on the session's time zone
        return "utc-instant-us", lambda c: F.unix_micros(c).cast("string"), lambda c: F.when(c.rlike(_WHOLE), F.timestamp_micros(c.try_cast("bigint")))
    if isinstance(kind, ArrayType) and isinstance(kind.elementType, StringType):
        return "array-json", lambda c: F.to_json(c, {"ignoreNullFields": "false"}), lambda c: F.from_json(c, "array<string>")
    raise ValueError(f"NO_CODEC_FOR_{kind.simpleString()}")


def encode_all(df: DataFrame) -> DataFrame:
    """Every column as its codec's text, names and order kept."""
    return df.select(*[codec(f.dataType)[1](F.col(f"`{f.name}`")).alias(f.name) for f in df.schema])


def decode_all(text: DataFrame, like: DataFrame) -> DataFrame:
    """Columns of the types of ``like`` from their texts."""
    return text.select(*[codec(f.dataType)[2](F.col(f"`{f.name}`")).alias(f.name) for f in like.schema])


def codec_faults(df: DataFrame) -> DataFrame:
    """``column, codec, cells, faults``: cells that do not come back equal, in one pass over ``df``."""
    fields = [(f.name, *codec(f.dataType)) for f in df.schema]
    wrong = [F.count_if(~dec(enc(F.col(f"`{n}`"))).eqNullSafe(F.col(f"`{n}`"))).alias(f"f{i}") for i, (n, _, enc, dec) in enumerate(fields)]
    cells = [F.count(F.col(f"`{n}`")).alias(f"n{i}") for i, (n, *_) in enumerate(fields)]
    one = df.agg(*cells, *wrong)
    rows = F.array(*[F.struct(F.lit(n).alias("column"), F.lit(name).alias("codec"), F.col(f"n{i}").alias("cells"), F.col(f"f{i}").alias("faults")) for i, (n, name, *_) in enumerate(fields)])
    return one.select(F.explode(rows).alias("r")).select("r.*")
