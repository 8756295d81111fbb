"""Decoders of the database's binary values, as column expressions: no Python runs on rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Days, and microseconds, from 1970-01-01 to 2000-01-01, where the database's time begins.
EPOCH_DAYS = 10957
EPOCH_MICROS = EPOCH_DAYS * 86400 * 1_000_000

# Sign words of a numeric.
POSITIVE, NEGATIVE, NAN, POSITIVE_INFINITY, NEGATIVE_INFINITY = 0x0000, 0x4000, 0xC000, 0xD000, 0xF000


def _unsigned(raw: Column, start: int | Column, size: int) -> Column:
    """The big-endian number in size bytes from place start (1 is first)."""
    return F.conv(F.hex(F.substring(raw, start, F.lit(size)) if isinstance(start, Column) else F.substring(raw, start, size)), 16, 10).cast("decimal(20,0)")


def _signed(raw: Column, start: int, size: int) -> Column:
    value, half = _unsigned(raw, start, size), F.lit(str(1 << (8 * size - 1))).cast("decimal(20,0)")
    whole = F.lit(str(1 << (8 * size))).cast("decimal(21,0)")
    return F.when(value >= half, value - whole).otherwise(value)


def _sized(raw: Column, size: int, value: Column, kind: str) -> Column:
    """value if raw has size bytes; null for null; else an error."""
    bad = F.raise_error(F.concat(F.lit(f"a {kind} has {size} bytes, not "), F.octet_length(raw).cast("string")))
    return F.when(raw.isNull(), F.lit(None)).when(F.octet_length(raw) == size, value).otherwise(bad)


def decode_date(raw: Column) -> Column:
    """A date of four bytes: days since 2000-01-01. The database's infinities are refused."""
    days = _signed(raw, 1, 4).cast("bigint")
    bounded = F.when(days.isin(-(1 << 31), (1 << 31) - 1), F.raise_error(F.lit("an infinite date can't be loaded"))).otherwise(days)
    return _sized(raw, 4, F.date_from_unix_date((bounded + EPOCH_DAYS).cast("int")), "date")


def decode_timestamp(raw: Column) -> Column:
    """A timestamp of eight bytes: microseconds since 2000-01-01, as an instant. The infinities are refused."""
    micros = _signed(raw, 1, 8)
    limits = [F.lit(str(x)).cast("decimal(20,0)") for x in (-(1 << 63), (1 << 63) - 1)]
    bounded = F.when((micros == limits[0]) | (micros == limits[1]), F.raise_error(F.lit("an infinite timestamp can't be loaded"))).otherwise(micros)
    return _sized(raw, 8, F.timestamp_micros((bounded + EPOCH_MICROS).cast("bigint")), "timestamp")


def typmod_precision(typmod: Column) -> Column:
    return F.shiftright(typmod - 4, 16).bitwiseAND(F.lit(0xFFFF))


def typmod_scale(typmod: Column) -> Column:
    return (typmod - 4).bitwiseAND(F.lit(0x7FF)).bitwiseXOR(F.lit(0x400)) - 0x400


def decode_numeric(raw: Column, precision: int, scale: int) -> Column:
    """A numeric as decimal(precision, scale); digits beyond the scale are cut off towards zero.

    Four words, the number of digits, weight, sign and display scale, come before base-10000 digits, the first of which
    counts 10000 to the power of the weight. NaN, infinities and short values are refused.
    """
    word = lambda place: _unsigned(raw, place, 2).cast("int")
    n, sign = word(1), word(5)
    weight = F.when(word(3) >= 0x8000, word(3) - 0x10000).otherwise(word(3))
    whole = "decimal(38,0)"

    def digit(i: Column) -> Column:
        """What digit i adds to the unscaled value."""
        value = _unsigned(raw, (i * 2 + 9).cast("int"), 2).cast("int")
        power = (weight - i) * 4 + scale
        cut = F.when(power <= -4, F.lit(0)).otherwise(F.floor(value / F.pow(F.lit(10), -power)).cast("int"))
        tens = F.rpad(F.lit("1"), F.greatest(power, F.lit(0)).cast("int") + 1, F.lit("0"))
        return F.when(value == 0, F.lit(0).cast(whole)).when(power < 0, cut.cast(whole)).otherwise((value.cast("decimal(5,0)") * tens.cast(whole)).cast(whole))

    places = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    total = F.aggregate(places, F.lit(0).cast(whole), lambda sum_, i: (sum_ + digit(i)).cast(whole))
    signed = F.when(sign == NEGATIVE, -total).otherwise(total).cast(whole)
    text = F.concat(F.when(signed < 0, F.lit("-")).otherwise(F.lit("")), F.lpad(F.abs(signed).cast("string"), F.greatest(F.length(F.abs(signed).cast("string")), F.lit(scale + 1)), F.lit("0")))
    value = text if not scale else F.concat(F.expr("''"), F.regexp_replace(text, f"([0-9]{{{scale}}})$", ".$1"))
    bad_sign = F.raise_error(F.concat(F.lit("a numeric of sign "), F.hex(sign), F.lit(" (NaN or infinite) can't be loaded")))
    short = F.raise_error(F.lit("a numeric ends too early"))
    return (
        F.when(raw.isNull(), F.lit(None).cast("string"))
        .when(F.octet_length(raw) < 8, short)
        .when(~sign.isin(POSITIVE, NEGATIVE), bad_sign)
        .when(F.octet_length(raw) < 8 + 2 * n, short)
        .otherwise(value)
        .cast(f"decimal({precision},{scale})")
    )
