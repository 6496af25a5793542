"""Numeric coercion expressions: invalid text becomes null, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marquee.functions.text import _col, strip_blanks

# Decimal or scientific notation, optional sign (no hex, no 'nan'/'inf').
NUMERIC_TEXT = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
DIGITS_ONLY = r"^[0-9]+$"


def to_int_id(c: Column | str) -> Column:
    """Text id -> bigint: strip, accept integer or numeric text, else null.

    "11" and "  11  " -> 11; "1e3" -> 1000; "11.5" -> 11; "ID-ERR", "" -> null.
    Out-of-range values give null instead of wrapping.
    """
    s = strip_blanks(c)
    return F.when(
        s.rlike(NUMERIC_TEXT),
        F.coalesce(s.try_cast("bigint"), s.try_cast("double").try_cast("bigint")),
    )


def to_double(c: Column | str) -> Column:
    """Any value -> double, NaN and invalid -> null (Spark orders NaN above +inf)."""
    d = _col(c).try_cast("double")
    return F.nanvl(d, F.lit(None).cast("double"))


def first_digit_run(c: Column | str, thousands_sep: str | None = None) -> Column:
    """First run of ASCII digits as bigint ("8578 views" -> 8578, "N/A" -> null).

    With ``thousands_sep`` a run may contain that separator between groups of
    three digits ("1.500 visitas" -> 1500).
    """
    c = _col(c)
    if thousands_sep:
        sep = "\\" + thousands_sep
        run = F.regexp_substr(c, F.lit(rf"[0-9]{{1,3}}({sep}[0-9]{{3}})+(?![0-9])|[0-9]+"))
        run = F.regexp_replace(run, sep, "")
    else:
        run = F.regexp_substr(c, F.lit(r"[0-9]+"))
    return run.try_cast("bigint")


def is_digits(c: Column | str) -> Column:
    """Stripped text made only of ASCII digits (API-candidate test)."""
    return F.coalesce(strip_blanks(c).rlike(DIGITS_ONLY), F.lit(False))
