"""Unpacking of dates and times as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _div(x, n: int) -> Column:
    return F.floor(x / F.lit(n)).cast("long")


def _bits(x: Column, shift: int, n: int) -> Column:
    return F.shiftright(x.cast("long"), shift).bitwiseAND(F.lit((1 << n) - 1))


def date_text(packed: Column) -> Column:
    """day in 5 bits, month in 4, year above."""
    return F.format_string("%04d-%02d-%02d", _bits(packed, 9, 23), _bits(packed, 5, 4), _bits(packed, 0, 5))


def pack_date(d: Column) -> Column:
    return (F.year(d) * 512 + F.month(d) * 32 + F.dayofmonth(d)).cast("long")


def _sign(x: Column) -> Column:
    return F.when(x < 0, F.lit("-")).otherwise(F.lit(""))


def time_text(decimal: Column) -> Column:
    """decimal HHMMSS, hours may pass 24, sign in front."""
    a = F.abs(decimal.cast("long"))
    return F.concat(_sign(decimal), F.format_string("%02d:%02d:%02d", _div(a, 10000), _div(a, 100) % 100, a % 100))


def fraction_text(micros: Column, fsp: int) -> Column:
    """The first fsp digits of six, after a point; nothing for 0."""
    if not fsp:
        return F.lit("")
    return F.concat(F.lit("."), F.substring(F.format_string("%06d", micros.cast("long")), 1, fsp))


def time2_text(packed: Column, fsp: int = 0) -> Column:
    """microseconds below, 24 bits of hours(10) minutes(6) seconds(6) above, signed as a whole."""
    a = F.abs(packed.cast("long"))
    hms = F.shiftright(a, 24)
    return F.concat(
        _sign(packed), F.format_string("%02d:%02d:%02d", _bits(hms, 12, 10), _bits(hms, 6, 6), _bits(hms, 0, 6)), fraction_text(_bits(a, 0, 24), fsp)
    )


def pack_time2(seconds: Column, micros: Column | None = None) -> Column:
    """Of seconds since midnight (or a longer span), not negative."""
    hms = _div(seconds, 3600) * 4096 + (_div(seconds, 60) % 60) * 64 + seconds.cast("long") % 60
    return hms * (1 << 24) + (micros if micros is not None else F.lit(0))


def datetime_text(decimal: Column) -> Column:
    """decimal YYYYMMDDhhmmss."""
    x = decimal.cast("long")
    return F.format_string("%04d-%02d-%02d %02d:%02d:%02d", _div(x, 10**10), _div(x, 10**8) % 100, _div(x, 10**6) % 100, _div(x, 10**4) % 100, _div(x, 100) % 100, x % 100)


def datetime2_text(packed: Column, micros: Column | None = None, fsp: int = 0) -> Column:
    """year*13+month, day(5), hour(5), minute(6), second(6), without the sign bias."""
    ym = _bits(packed, 22, 17)
    text = F.format_string(
        "%04d-%02d-%02d %02d:%02d:%02d", _div(ym, 13), ym % 13, _bits(packed, 17, 5), _bits(packed, 12, 5), _bits(packed, 6, 6), _bits(packed, 0, 6)
    )
    return F.concat(text, fraction_text(micros, fsp)) if fsp else text


def pack_datetime2(t: Column) -> Column:
    ymd = ((F.year(t) * 13 + F.month(t)) * 32 + F.dayofmonth(t)).cast("long")
    return ymd * (1 << 17) + (F.hour(t) * 4096 + F.minute(t) * 64 + F.second(t)).cast("long")


def epoch_text(seconds: Column, micros: Column | None = None, fsp: int = 0) -> Column:
    """seconds since 1970, with fsp digits of the fraction."""
    return F.concat(seconds.cast("long").cast("string"), fraction_text(micros, fsp)) if fsp else seconds.cast("long").cast("string")


def year_text(b: Column) -> Column:
    """F15."""
    return (b + 1900).cast("int").cast("string")
