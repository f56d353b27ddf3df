"""How change records and events carry typed values, and back.

A decimal travels as the big-endian two's complement bytes of its unscaled
value, a date as days since 1970, and a time as ISO-8601 text in change records
(``ISO``) and as milliseconds since 1970 in events (``MILLIS``). In JSON, bytes
are base64 text. All other types travel as they are.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

ISO, MILLIS = "iso", "millis"
LONG_DIGITS = 18  # decimals of more digits do not fit eight bytes


def _wire_type(kind: T.DataType, times: str) -> T.DataType:
    if isinstance(kind, T.DecimalType):
        if kind.precision > LONG_DIGITS:
            raise ValueError(f"{kind.simpleString()} has more than {LONG_DIGITS} digits")
        return T.BinaryType()
    if isinstance(kind, T.DateType):
        return T.IntegerType()
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return T.LongType() if times == MILLIS else T.StringType()
    return kind


def wire_schema(row: T.StructType, times: str = ISO) -> T.StructType:
    """The types under which the fields of ``row`` travel."""
    return T.StructType([T.StructField(f.name, _wire_type(f.dataType, times)) for f in row])


def decimal_of(unscaled: Column, kind: T.DecimalType) -> Column:
    """The decimal of big-endian two's complement bytes; no bytes are 0, values that do not fit NULL."""
    digits = F.hex(unscaled)
    sign = F.when(F.substring(digits, 1, 1) >= "8", "F" * 16).otherwise("0" * 16)
    whole = F.conv(F.substring(F.concat(sign, digits), -16, 16), 16, -10).cast("decimal(19,0)")
    return (whole * F.lit(Decimal(1).scaleb(-kind.scale))).try_cast(kind)


def unscaled_of(value: Column, kind: T.DecimalType) -> Column:
    """The fewest whole bytes of a decimal, or eight if it is negative."""
    whole = (value * F.lit(Decimal(10) ** kind.scale)).cast("bigint")
    digits = F.hex(whole)
    even = F.when(F.length(digits) % 2 == 1, F.concat(F.lit("0"), digits)).otherwise(digits)
    return F.unhex(F.when((whole >= 0) & (F.substring(even, 1, 1) >= "8"), F.concat(F.lit("00"), even)).otherwise(even))


def decode(value: Column, kind: T.DataType, times: str = ISO) -> Column:
    """A wire value as ``kind``; times that cannot be read are NULL."""
    if isinstance(kind, T.DecimalType):
        return decimal_of(value, kind)
    if isinstance(kind, T.DateType):
        return F.date_from_unix_date(value)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return (F.timestamp_millis(value) if times == MILLIS else F.try_to_timestamp(value)).cast(kind)
    return value


def encode(value: Column, kind: T.DataType, times: str = ISO) -> Column:
    """``value`` as it travels."""
    if isinstance(kind, T.DecimalType):
        return unscaled_of(value, kind)
    if isinstance(kind, T.DateType):
        return F.unix_date(value)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        moment = value.cast("timestamp")
        return F.unix_millis(moment) if times == MILLIS else F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    return value


def decode_row(value: Column, row: T.StructType, times: str = ISO) -> Column:
    """A wire struct as ``row``; NULL stays NULL."""
    return F.when(value.isNotNull(), F.struct(*[decode(value[f.name], f.dataType, times).alias(f.name) for f in row]))


def encode_row(row: T.StructType, times: str = ISO) -> Column:
    """The columns of ``row`` as a wire struct."""
    return F.struct(*[encode(F.col(f.name), f.dataType, times).alias(f.name) for f in row])
