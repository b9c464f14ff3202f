"""How single values are rendered as text; every function maps a column to a column."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

_HALF_MILLISECOND = "INTERVAL '0.0005' SECOND"
_HALF_MINUTE = "INTERVAL '30' SECOND"


def rowversion_hex(value: Column) -> Column:
    """Row version as ``0x`` and upper-case hex digits."""
    return F.concat(F.lit("0x"), F.hex(value))


def rowversion_bytes(number: Column) -> Column:
    """The 8-byte row version of a whole number."""
    return F.unhex(F.lpad(F.hex(number), 16, "0"))


def enclose(value: Column) -> Column:
    """Text in double quotes with inner quotes doubled; NULL stays NULL."""
    return F.concat(F.lit('"'), F.replace(value, F.lit('"'), F.lit('""')), F.lit('"'))


def null_to_empty(value: Column) -> Column:
    return F.coalesce(value, F.lit(""))


def timestamp_digits(value: Column, digits: int) -> Column:
    """Wall time with ``digits`` decimals of a second, cut and not rounded.

    The time is cast and its text is cut. Formatting functions would first turn a time without a zone
    into one of the session's zone, and so move times that a change of clocks skips.
    """
    shown = value.cast("string")
    whole = F.substring_index(shown, ".", 1)
    if digits == 0:
        return whole
    decimals = F.when(F.contains(shown, F.lit(".")), F.substring_index(shown, ".", -1)).otherwise("")
    return F.concat(whole, F.lit("."), F.rpad(decimals, digits, "0"))


def timestamp_ms(value: Column) -> Column:
    """Wall time rounded to milliseconds: half a step is added before the text is cut, which is right
    for both timestamp types and for times before 1970."""
    return timestamp_digits(value + F.expr(_HALF_MILLISECOND), 3)


def timestamp_minute(value: Column) -> Column:
    """Wall time rounded to the minute."""
    return F.concat(F.substring_index((value + F.expr(_HALF_MINUTE)).cast("string"), ":", 2), F.lit(":00"))


def minute_start(value: Column) -> Column:
    """The minute a time falls into, as a time of the same type."""
    zero = F.lit(0)
    return value - F.make_dt_interval(zero, zero, zero, F.extract(F.lit("SECOND"), value))


def nul_cleanup(value: Column) -> Column:
    """A text that is exactly one NUL becomes empty; a NUL inside a longer text is kept."""
    return F.when(value == F.char(F.lit(0)), F.lit("")).otherwise(value)


def sanitize(value: Column) -> Column:
    """Name made of letters, digits and single underscores between them."""
    return F.regexp_replace(F.regexp_replace(value, "[^A-Za-z0-9]+", "_"), "^_|_$", "")


def sanitize_name(name: str) -> str:
    return re.sub("[^A-Za-z0-9]+", "_", name).strip("_")


def sanitize_names(names: list[str]) -> list[str]:
    """Sanitized names in order; a name that is already taken gets the next free number."""
    taken: set[str] = set()
    result = []
    for name in names:
        wanted = sanitize_name(name) or "column"
        free, n = wanted, 1
        while free.lower() in taken:
            n += 1
            free = f"{wanted}_{n}"
        taken.add(free.lower())
        result.append(free)
    return result
