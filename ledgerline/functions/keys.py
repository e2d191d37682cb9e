"""Keys of any columns as one binary value whose byte order is the order of the columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, BooleanType, ByteType, DataType, DateType, DecimalType, IntegerType, LongType, ShortType, StringType, TimestampType

#: What is after every key.
BEYOND = b"\xff"
DIGITS = 38


def _number(value: Column) -> Column:
    """Eight bytes, highest first, with the sign turned."""
    return F.unhex(F.lpad(F.hex(value.cast("bigint").bitwiseXOR(F.lit(-(1 << 63)))), 16, "0"))


def _text(value: Column) -> Column:
    """The bytes with an end mark of two zeros; a zero within is followed by a one, so that no value holds the mark."""
    return F.concat(F.replace(value, F.lit("\x00"), F.lit("\x00\x01")), F.lit("\x00\x00"))


def _decimal(value: Column) -> Column:
    """A sign and DIGITS digits, those of a negative number each taken from 9."""
    digits = F.lpad(F.regexp_replace(F.abs(value).cast("string"), r"[^0-9]", ""), DIGITS, "0")
    return F.when(value < 0, F.concat(F.lit("0"), F.translate(digits, "0123456789", "9876543210"))).otherwise(F.concat(F.lit("1"), digits)).cast("binary")


def _encoded(value: Column, kind: DataType) -> Column:
    if isinstance(kind, (ByteType, ShortType, IntegerType, LongType, BooleanType)):
        return _number(value.cast("int") if isinstance(kind, BooleanType) else value)
    if isinstance(kind, DateType):
        return _number(F.unix_date(value))
    if isinstance(kind, TimestampType):
        return _number(F.unix_micros(value))
    if isinstance(kind, DecimalType):
        return _decimal(value)
    if isinstance(kind, StringType):
        return _text(value).cast("binary")
    if isinstance(kind, BinaryType):
        return F.encode(_text(F.decode(value, "ISO-8859-1")), "ISO-8859-1")
    raise ValueError("unsupported_key_type")  # floating numbers, which aren't equal to themselves, and nested types


def ordered_key(df: DataFrame, *columns: str) -> Column:
    """The key of df's columns, whose bytes compare as the columns do, one after the other, null first, text by its bytes.

    Numbers, decimals, texts, bytes, dates and times may be part of a key; keys of the same columns compare with each other.
    """
    parts = []
    for c in columns:
        value = F.col(c)
        parts.append(F.when(value.isNull(), F.unhex(F.lit("00"))).otherwise(F.concat(F.unhex(F.lit("01")), _encoded(value, df.schema[c].dataType))))
    return F.concat(*parts)
