"""Security identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: symbol order of the check-digit scheme.
CUSIP_ALPHABET = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ*@#"


def cusip_check_digit(code: Column) -> Column:
    """Check digit of an 8-character code: every second symbol doubled, digits summed.

    Null when a symbol is outside the alphabet.
    """

    def digit_sum(symbol: Column, index: Column) -> Column:
        position = F.position(symbol, F.lit(CUSIP_ALPHABET))
        value = F.when(position > 0, position - 1) * (F.lit(1) + index % 2)
        return F.floor(value / 10) + value % 10

    symbols = F.filter(F.split(code, ""), lambda s: s != "")
    total = F.aggregate(
        F.transform(symbols, digit_sum), F.lit(0).cast("bigint"), lambda acc, x: acc + x
    )
    return F.pmod(F.lit(10) - total, F.lit(10)).cast("string")


def cusip_8_to_9(code: Column) -> Column:
    return F.concat(code, cusip_check_digit(code))
