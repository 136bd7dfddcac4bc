"""Tolerant typing of raw text columns.

Spark 4 runs with ANSI mode on, where a plain ``cast`` of bad text raises. The
raw layer is text from CSV files, so every conversion here is total: a value
that does not parse becomes NULL and can be counted, never aborts a job.
"""

from __future__ import annotations

from enum import Enum

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed pattern: optional sign, digits, optional fraction, surrounding
# whitespace allowed. The integer part is kept and the fraction dropped
# ('12.5' -> 12, '-3.9' -> -3); anything else (exponents, hex, words, empty
# text) yields NULL, and overflow yields NULL too.
INTEGER_TEXT = r"^\s*([+-]?[0-9]+)([.][0-9]*)?\s*$"

# Fixed pattern: an identifier may carry a zero fraction ('12.0'), no other.
IDENTIFIER_TEXT = r"^\s*([+-]?[0-9]+)([.]0*)?\s*$"

# Fixed pattern: a time of day followed by a UTC offset or Z.
ZONED_TEXT = r"[0-9]{1,2}:[0-9.:]+\s*(?:[Zz]|(?:UTC|GMT)?[+-][0-9]{1,2}(?::?[0-9]{2})?)\s*$"

# A date text of exactly this many characters (``yyyy-MM``) lacks its day.
INCOMPLETE_DATE_LENGTH = 7


class Role(str, Enum):
    """How a raw text column is typed."""

    TRIM = "trim"  # string, surrounding spaces removed
    INT = "int"  # tolerant 32-bit integer
    LONG = "long"  # tolerant 64-bit integer
    KEY = "key"  # 64-bit identifier; a fraction other than zero is a reject
    DOUBLE = "double"  # tolerant double
    FLAG = "flag"  # 'true'/'false' in any case, else NULL
    TIMESTAMP = "timestamp"  # wall-clock timestamp (no time zone)


def _c(c: "Column | str") -> Column:
    return F.col(c) if isinstance(c, str) else c


def trimmed(c: "Column | str") -> Column:
    """Remove surrounding spaces (spaces only; tabs are kept)."""
    return F.trim(_c(c))


def tolerant_int(c: "Column | str", bits: int = 32) -> Column:
    """Integer part of a numeric text; NULL for other text or on overflow.

    Text of a few plain digits is cast at once; the pattern isolates the digits
    of the rest, so that no cast fails but on overflow (a failing one is slow).
    """
    return _integer(_c(c), INTEGER_TEXT, "int" if bits == 32 else "long")


def _integer(text: Column, pattern: str, kind: str) -> Column:
    plain = text.rlike(r"^[0-9]{1,9}\z" if kind == "int" else r"^[0-9]{1,18}\z")
    digits = F.regexp_extract(text, pattern, 1)
    return F.when(plain, text.cast(kind)).otherwise(F.nullif(digits, F.lit("")).try_cast(kind))


def tolerant_long(c: "Column | str") -> Column:
    return tolerant_int(c, bits=64)


def tolerant_key(c: "Column | str") -> Column:
    """64-bit identifier: like :func:`tolerant_long`, but ``12.5`` is NULL (``12.0`` stays 12)."""
    return _integer(_c(c), IDENTIFIER_TEXT, "long")


def tolerant_double(c: "Column | str") -> Column:
    return _c(c).try_cast("double")


def strict_flag(c: "Column | str") -> Column:
    """'true' / 'false' in any letter case; everything else (incl. '1', 't',
    ' true' with a space) is NULL."""
    low = F.lower(_c(c))
    return F.when(low == F.lit("true"), F.lit(True)).when(low == F.lit("false"), F.lit(False))


def parse_timestamp(c: "Column | str") -> Column:
    """Text to ``timestamp_ntz``; unparsable text is NULL.

    Wall-clock semantics: the result does not depend on the session time zone.
    Text that ends in a UTC offset names an instant, which is given by its UTC
    wall clock; other text is taken as it stands.
    """
    text = _c(c)
    seconds = (F.unix_micros(text.try_cast("timestamp")).cast("decimal(20,0)") / F.lit(1_000_000)).cast("decimal(18,6)")
    utc = F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)
    return F.when(text.rlike(ZONED_TEXT), utc).otherwise(text.try_cast("timestamp_ntz"))


def is_incomplete_date(c: "Column | str") -> Column:
    """True for a 7-character date text such as ``2021-06``."""
    return F.length(_c(c)) == F.lit(INCOMPLETE_DATE_LENGTH)


def repaired_timestamp(text: "Column | str", ship_text: "Column | str", impute: bool, days_before: int = 7) -> Column:
    """Typed order date with incomplete texts repaired.

    Incomplete (7-character) values become NULL, or, when ``impute`` is set,
    midnight of ``ship date - days_before`` (NULL if the ship date is NULL).
    """
    if impute:
        fix = F.date_sub(parse_timestamp(ship_text).cast("date"), days_before).cast("timestamp_ntz")
    else:
        fix = F.lit(None).cast("timestamp_ntz")
    return F.when(is_incomplete_date(text), fix).otherwise(parse_timestamp(text))


_TYPERS = {
    Role.TRIM: trimmed,
    Role.INT: tolerant_int,
    Role.LONG: tolerant_long,
    Role.KEY: tolerant_key,
    Role.DOUBLE: tolerant_double,
    Role.FLAG: strict_flag,
    Role.TIMESTAMP: parse_timestamp,
}


def typed(c: "Column | str", role: "Role | str") -> Column:
    return _TYPERS[Role(role)](c)
