"""Money codec of the change log, as column expressions."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, functions as F

_HALF = 8


def _short_integer(raw: Column) -> Column:
    """Up to eight big-endian two's-complement bytes as BIGINT: read as they are, then the sign is spread by shifts."""
    bits = F.conv(F.hex(raw), 16, -10).cast("bigint")
    unused = (64 - 8 * F.length(raw)).cast("int")
    return F.call_function("shiftright", F.call_function("shiftleft", bits, unused), unused)


def _long_integer(raw: Column) -> Column:
    """Big-endian two's-complement bytes as DECIMAL(38,0): any length as long as the value fits, else null."""
    # Leading bytes that only repeat the sign carry nothing.
    digits = F.regexp_replace(F.hex(raw), "^((?:00)+(?=[0-7])|(?:FF)+(?=[89A-F]))", "")
    fill = F.when(digits >= "8", "F").otherwise("0")
    wide = F.lpad(digits, F.lit(4 * _HALF), fill)
    # A negative base makes conv read the 64 bits as signed.
    high = F.conv(F.substring(wide, 1, 2 * _HALF), 16, -10).cast("decimal(20,0)")
    low = F.conv(F.substring(wide, 2 * _HALF + 1, 2 * _HALF), 16, 10).cast("decimal(20,0)")
    whole = F.try_add(F.try_multiply(high, F.lit(Decimal(1 << 64))), low)
    return F.when(F.length(digits) <= 4 * _HALF, whole.try_cast("decimal(38,0)"))


def _known(text: Column, scale: int, precision: int, plain: Column | None = None) -> tuple[Column, Column, Column]:
    """Bytes of the text, and its value by the short and by the long way; what is no such value falls back on ``plain``.

    Nearly all money has eight bytes at most; only the branch taken is computed.
    """
    kind, unit = f"decimal({precision},{scale})", F.lit(Decimal(1).scaleb(-scale))
    raw = F.try_to_binary(text, F.lit("base64"))
    short = (_short_integer(raw).cast("decimal(19,0)") * unit).try_cast(kind)
    long_ = F.try_multiply(_long_integer(raw), unit).try_cast(kind)
    if plain is not None:
        short, long_ = F.coalesce(short, plain), F.coalesce(long_, plain)
    return raw, short, long_


def decode_base64(text: Column, scale: int = 2, precision: int = 12) -> Column:
    """Decoded value, or null for text that is not base64 or does not fit."""
    raw, short, long_ = _known(text, scale, precision)
    return F.when(F.length(raw).between(1, _HALF), short).when(F.length(raw) > _HALF, long_)


def overflows(text: Column, wire: str = "base64", scale: int = 2, precision: int = 12) -> Column:
    """Whether the text holds a number that the money column cannot; such a message belongs to the dead letters."""
    unread = parse_amount(text, wire, scale, precision).isNull()
    return F.coalesce(text.isNotNull() & unread, F.lit(False))


def _number(text: Column, scale: int, precision: int) -> Column:
    """A plain number; null if it is too large, 0 if it is none."""
    kind = f"decimal({precision},{scale})"
    return F.coalesce(text.try_cast(kind), F.when(text.try_cast("double").isNull(), F.lit(0).cast(kind)))


def decode_decimal(text: Column, scale: int = 2, precision: int = 12) -> Column:
    """Base64 money; plain numbers pass through; null and bad text give 0, a value too large for the type null."""
    raw, short, long_ = _known(text, scale, precision, text.try_cast(f"decimal({precision},{scale})"))
    size = F.length(raw)
    return F.when(size.between(1, _HALF), short).when(size > _HALF, long_).otherwise(_number(text, scale, precision))


def parse_amount(text: Column, wire: str = "base64", scale: int = 2, precision: int = 12) -> Column:
    """Money column under its configured wire form; 0 where it cannot be read, null where it is too large."""
    if wire == "base64":
        return decode_decimal(text, scale, precision)
    if wire in ("string", "number"):
        return _number(text, scale, precision)
    raise ValueError(f"unknown wire form: {wire}")


def encode_decimal(amount: Column, scale: int = 2) -> Column:
    """Inverse of the base64 form, with the fewest bytes that hold the value."""
    units = (amount * F.lit(10**scale)).cast("bigint")
    # Bits besides the sign: those of the value, or of its complement when it is negative.
    bits = F.length(F.bin(units.bitwiseXOR(F.shiftright(units, 63))))
    n_bytes = F.floor(bits / 8).cast("int") + 1
    digits = F.lpad(F.hex(units), 2 * _HALF, "0")
    return F.base64(F.unhex(F.substring(digits, F.lit(2 * _HALF + 1) - n_bytes * 2, n_bytes * 2)))
