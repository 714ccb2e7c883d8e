"""String functions with the Java semantics the record formats rely on."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

Name = Column | str


def _col(value: Name) -> Column:
    return F.col(value) if isinstance(value, str) else value


def java_split(value: Name) -> Column:
    """Tokens between single spaces; trailing empty tokens are dropped, inner ones kept.

    An empty string is one empty token, a blank one has no token at all.
    """
    text = _col(value)
    body = F.rtrim(text)
    tokens = F.split(body, " ")
    return (
        F.when(text == "", F.array(F.lit("")))
        .when(body == "", F.slice(tokens, 1, 0))
        .otherwise(tokens)
    )


def _to_int32(low: Column) -> Column:
    """The signed value of 32 low bits."""
    return F.when(low >= F.lit(1 << 31), low - F.lit(1 << 32)).otherwise(low).cast("int")


def java_string_hash(value: Name) -> Column:
    """``h = 31 * h + unit`` over the UTF-16 units, as a signed 32-bit integer."""
    text = _col(value)
    modulus = F.lit(1 << 32)

    def feed(acc: Column, unit: Column) -> Column:
        return F.pmod(acc * 31 + unit, modulus)

    def step(acc: Column, char: Column) -> Column:
        point = F.ascii(char).cast("bigint")
        extra = point - 0x10000
        high = F.lit(0xD800) + F.shiftright(extra, 10)
        low = F.lit(0xDC00) + extra.bitwiseAND(F.lit(0x3FF).cast("bigint"))
        return F.when(point < 0x10000, feed(acc, point)).otherwise(feed(feed(acc, high), low))

    chars = F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, ""))
    return F.aggregate(chars, F.lit(0).cast("bigint"), step, _to_int32)


def java_long_hash(value: Name) -> Column:
    """Exclusive or of both halves of a 64-bit integer."""
    number = _col(value).cast("bigint")
    halves = number.bitwiseXOR(F.shiftrightunsigned(number, 32))
    return _to_int32(F.pmod(halves, F.lit(1 << 32)))


def java_hash(value: Name, data_type: str) -> Column:
    """Object hash by type: strings fold, 32-bit integers are themselves, longs fold halves."""
    if data_type == "string":
        return java_string_hash(value)
    if data_type in ("int", "smallint", "tinyint"):
        return _col(value).cast("int")
    if data_type == "bigint":
        return java_long_hash(value)
    if data_type == "boolean":
        return F.when(_col(value), 1231).otherwise(1237)
    raise TypeError(f"no hash for {data_type}")
