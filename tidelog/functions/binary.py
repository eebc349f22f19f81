"""Byte-level scalar functions as column expressions (B-1 to B-8)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def byte_at(b: Column, offset) -> Column:
    """The unsigned byte at a 0-based offset."""
    return F.conv(F.hex(F.substring(b, _col(offset) + 1, F.lit(1))), 16, 10).cast("int")


def _hex_le(b: Column, offset, n: int) -> Column:
    h = F.hex(F.substring(b, _col(offset) + 1, F.lit(n)))
    return F.concat(*[F.substring(h, 2 * k + 1, 2) for k in reversed(range(n))])


def le_uint(b: Column, offset, n: int) -> Column:
    """B-1: little-endian unsigned integer of n bytes; bigint, or decimal(20,0) for 8 bytes."""
    return F.conv(_hex_le(b, offset, n), 16, 10).cast("decimal(20,0)" if n == 8 else "bigint")


def le_int(b: Column, offset, n: int) -> Column:
    """B-2: little-endian two's complement integer of n bytes."""
    if n == 8:
        return F.conv(_hex_le(b, offset, 8), 16, -10).cast("bigint")
    x = le_uint(b, offset, n)
    return x - F.when(x >= 1 << (8 * n - 1), F.lit(1 << 8 * n)).otherwise(F.lit(0))


def be_uint(b: Column) -> Column:
    """F16: big-endian unsigned integer of all bytes."""
    return F.conv(F.hex(b), 16, 10).cast("decimal(20,0)")


def lenenc_int(b: Column, offset=0) -> Column:
    """B-3: length-encoded integer; null for the markers 0xfb and 0xff."""
    first = byte_at(b, offset)
    after = _col(offset) + 1
    wide = lambda n: le_uint(b, after, n).cast("decimal(20,0)")
    return F.when(first < 0xFB, first.cast("decimal(20,0)")).when(first == 0xFC, wide(2)).when(first == 0xFD, wide(3)).when(first == 0xFE, wide(8))


def lenenc_size(b: Column, offset=0) -> Column:
    """Bytes taken by a length-encoded integer."""
    first = byte_at(b, offset)
    return F.when(first < 0xFB, 1).when(first == 0xFC, 3).when(first == 0xFD, 4).when(first == 0xFE, 9).otherwise(1)


def lenenc_string(b: Column, offset=0) -> Column:
    """B-4: length-encoded bytes."""
    return F.substring(b, _col(offset) + lenenc_size(b, offset) + 1, lenenc_int(b, offset).cast("int"))


def bitmap(b: Column, n, offset=0) -> Column:
    """B-5: the first n bits, lowest bit of each byte first, as booleans."""
    bits = F.transform(F.sequence(F.lit(0), _col(n) - 1), lambda i: F.shiftright(byte_at(b, _col(offset) + F.floor(i / 8).cast("int")), 0).bitwiseAND(F.element_at(F.lit([1, 2, 4, 8, 16, 32, 64, 128]), (i % 8 + 1).cast("int"))) != 0)
    return F.when(_col(n) > 0, bits).otherwise(F.array().cast("array<boolean>"))


def fraction_bytes(fsp) -> Column:
    """B-6: bytes that store fsp fractional digits."""
    return F.floor((_col(fsp) + 1) / 2).cast("int")


def hex_literal(b: Column) -> Column:
    """B-7: 0x and lower-case digits."""
    return F.concat(F.lit("0x"), F.lower(F.hex(b)))


def uuid_text(b: Column, offset=0) -> Column:
    """B-8: 16 bytes as text in groups of 8-4-4-4-12."""
    h = F.lower(F.hex(F.substring(b, _col(offset) + 1, F.lit(16))))
    return F.concat_ws("-", *[F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])


def uuid_bytes(text: Column) -> Column:
    """Uuid text as 16 bytes; null if it is none."""
    h = F.replace(text, F.lit("-"), F.lit(""))
    return F.when(h.rlike("^[0-9A-Fa-f]{32}$"), F.unhex(h))
