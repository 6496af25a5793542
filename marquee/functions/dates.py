"""Date parsing: try each format in order, invalid -> null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marquee.config import DATE_FORMATS
from marquee.functions.text import strip_blanks


# Cheap shape tests run before each parser, so text that cannot match a
# format (words, other layouts, day 0 or over 31, month 0 or over 12, such as
# "00/00/0000") never reaches the date parser's failure path. Only days a
# month lacks (31/02) are left to the parser.
_DAY = r"(0?[1-9]|[12][0-9]|3[01])"
_MONTH = r"(0?[1-9]|1[0-2])"
_SHAPES = {
    "yyyy-M-d": rf"^[0-9]{{4}}-{_MONTH}-{_DAY}$",
    "d/M/yyyy": rf"^{_DAY}/{_MONTH}/[0-9]{{4}}$",
}


def parse_date(c: Column | str, formats: tuple[str, ...] = DATE_FORMATS) -> Column:
    """ISO (yyyy-M-d), then day/month/year; impossible dates and words -> null."""
    s = strip_blanks(c)
    tries = []
    for f in formats:
        parsed = F.try_to_date(s, f)
        tries.append(F.when(s.rlike(_SHAPES[f]), parsed) if f in _SHAPES else parsed)
    return F.coalesce(*tries)
