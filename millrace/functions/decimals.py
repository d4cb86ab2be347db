"""Decimals as the bytes of their unscaled value, in native expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

_WHOLE = "decimal(38,0)"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def decimal_to_bytes(value: Column, scale: int) -> Column:
    """Big-endian two's complement of the unscaled value, as short as it can be; null for null."""
    word, half = (F.lit(str(1 << n)).cast(_WHOLE) for n in (64, 63))
    zero = F.lit(0).cast(_WHOLE)

    def halves(unscaled: Column) -> Column:
        low = (unscaled % word).cast(_WHOLE)
        high = F.call_function("div", unscaled, word) - F.when(low < 0, 1).otherwise(0)
        rest = (low + F.when(low < 0, word).otherwise(zero)).cast(_WHOLE)
        signed = (rest - F.when(rest >= half, word).otherwise(zero)).cast("bigint")
        digits = F.concat(F.lpad(F.hex(high), 16, "0"), F.lpad(F.hex(signed), 16, "0"))
        return F.unhex(F.regexp_replace(digits, r"^(?:(?:00)+(?=[0-7].)|(?:FF)+(?=[89A-F].))", ""))

    def unscaled(number: Column) -> Column:
        # a number under one, plus one, is never printed with an exponent; its leading 1 is then a 0
        small = F.abs(number).cast(f"decimal({max(scale, 1)},{scale})") + F.lit(1).cast("decimal(1,0)")
        below = F.concat(F.when(number < 0, F.lit("-0")).otherwise(F.lit("0")), F.substring(small.cast("string"), F.lit(2), F.lit(64)))
        text = F.when(F.abs(number) < 1, below).otherwise(number.cast("string")) if scale else number.cast("string")
        return F.replace(text, F.lit("."), F.lit("")).cast(_WHOLE)

    return F.when(value.isNotNull(), let(let(value.cast(f"decimal(38,{scale})"), unscaled), halves))


def bytes_to_decimal(data: Column, scale: int) -> Column:
    """The decimal of such bytes. Values beyond 38 digits raise, as the type cannot hold them; null for null."""

    def fold(digits: Column) -> Column:
        def byte(i: Column) -> Column:
            return F.conv(F.substring(digits, 2 * i + 1, F.lit(2)), 16, 10).cast("int")

        first = byte(F.lit(0))
        start = (first - F.when(first >= 128, 256).otherwise(0)).cast(_WHOLE)
        later = F.filter(F.sequence(F.lit(0), (F.length(digits) / 2 - 1).cast("int")), lambda i: i > 0)
        whole = F.aggregate(later, start, lambda a, i: (a * 256 + byte(i)).cast(_WHOLE))
        return F.concat(whole.cast("string"), F.lit(f"E-{scale}")).cast(f"decimal(38,{scale})")

    return F.when(F.length(data) > 0, let(F.hex(data), fold))
