"""JSON records to columns and back, and the windowed sink key."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moodtide.schemas import CHAT_MESSAGE_INVALID, SERIALIZATION_ERROR

# Only what a strict JSON reader takes: Spark's own defaults are looser.
_STRICT_JSON = {
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": "_corrupt",
    "allowSingleQuotes": "false",
    "allowNonNumericNumbers": "false",
}


def snake_case(name: str) -> str:
    return re.sub(r"(?<=[a-z0-9])([A-Z])", r"_\1", name).lower()


# A JSON number, and a whole number in quotes. Java's own suffixes (``12d``) are neither.
_JSON_NUMBER = r"^-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?$"
_QUOTED_WHOLE = r"^\s*[+-]?[0-9]+\s*$"


def _number(text: Column, kind: T.DataType, quoted: Column) -> Column:
    """A number field as a Java bean reader takes it: absent, null or blank is 0, ``"12"`` is 12, a
    bare fraction is cut for an integer field but a quoted one is no integer. NULL where the text is
    no number."""
    parsed = text.try_cast(kind)
    if isinstance(kind, (T.LongType, T.IntegerType)):
        bare = F.when(~quoted & text.rlike(_JSON_NUMBER), text.try_cast("double").try_cast(kind))
        parsed = F.when(text.rlike(_QUOTED_WHOLE), parsed).otherwise(bare)
    return F.when(text.isNull() | (F.trim(text) == ""), F.lit(0).cast(kind)).otherwise(parsed)


def _is_quoted(name: str) -> Column:
    """Whether the record has this field in quotes. Only asked of numbers that are not whole."""
    return F.col("_text").rlike(f'"{re.escape(name)}"\\s*:\\s*"')


def decode_json(df: DataFrame, schema: T.StructType, value_col: str = "value", mode: str = "permissive") -> DataFrame:
    """Replace ``value_col`` by the record's fields (snake-cased) and ``error_code``.

    ``error_code`` is NULL for a good record, 2002 for text that does not decode, 3000 for a
    null record. ``mode="strict"`` fails the job on the first bad record instead. Unknown
    fields are ignored. Number fields are read as text first, so that a quoted number counts
    as one and a wrong type is told apart from an absent field.
    """
    if mode not in ("permissive", "strict"):
        raise ValueError("mode is 'permissive' or 'strict'")
    numbers = [f.name for f in schema if isinstance(f.dataType, T.NumericType)]
    wire = T.StructType(
        [T.StructField(f.name, T.StringType() if f.name in numbers else f.dataType) for f in schema]
        + [T.StructField("_corrupt", T.StringType())]
    )
    text = F.col(value_col).cast("string")
    parsed = df.withColumn("_text", text).withColumn("_record", F.from_json("_text", wire, _STRICT_JSON))

    fields = {
        snake_case(f.name): _number(F.col(f"_record.{f.name}"), f.dataType, _is_quoted(f.name))
        if f.name in numbers
        else F.col(f"_record.{f.name}")
        for f in schema
    }
    absent = F.col("_text").isNull() | (F.trim("_text") == "null")
    broken = F.col("_record").isNull() | F.col("_record._corrupt").isNotNull()
    for name in numbers:
        broken = broken | F.col(snake_case(name)).isNull()
    out = (
        parsed.drop(value_col)
        .withColumns(fields)
        .withColumn(
            "error_code", F.when(absent, F.lit(CHAT_MESSAGE_INVALID)).when(broken, F.lit(SERIALIZATION_ERROR))
        )
    )
    if mode == "strict":
        failure = F.raise_error(F.concat(F.lit("cannot decode record, code "), F.col("error_code")))
        out = out.filter(F.when(F.col("error_code").isNull(), F.lit(True)).otherwise(failure.cast("boolean")))
    return out.drop("_text", "_record")


def encode_json(schema: T.StructType) -> Column:
    """The record as JSON text, fields in schema order, null fields written out."""
    fields = [F.col(snake_case(f.name)).cast(f.dataType).alias(f.name) for f in schema]
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def windowed_key(key: Column, window_start_ms: Column) -> Column:
    """Binary key of a windowed record: key bytes, then the window start as 8 bytes big-endian."""
    start = F.unhex(F.lpad(F.hex(window_start_ms.cast("bigint")), 16, "0"))
    return F.concat(F.encode(key, "UTF-8"), start)


def split_windowed_key(key: Column) -> tuple[Column, Column]:
    """The inverse of ``windowed_key``: (key text, window start in ms)."""
    size = F.octet_length(key)
    text = F.decode(F.substr(key, F.lit(1), size - 8), "UTF-8")
    start = F.conv(F.hex(F.substr(key, size - 7, F.lit(8))), 16, -10).cast("bigint")
    return text, start
