"""Text cleaning expressions (JVM-side, no UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The 29 code points treated as blank (the Unicode whitespace
# set of Python's str.isspace, which the reproduced cleaning strips).
BLANK_CHARS = (
    "\u0009\u000a\u000b\u000c\u000d\u001c\u001d\u001e\u001f\u0020\u0085\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# The same set as a regex class: Java's Unicode White_Space (?U)\s is the set
# above minus 0x1c-0x1f, which are added back. Used to collapse inner runs.
_RUN = r"(?U)[\s\x1c-\x1f]+"
# Text needs collapsing only if it has two blanks in a row or a blank other
# than the plain space; most titles have neither and skip the rewrite.
_NEEDS_COLLAPSE = r"(?U)[\s\x1c-\x1f]{2}|[^\S ]|[\x1c-\x1f]"
# Runs of cased letters, or runs of anything else; title case applies per run.
_CASED_RUNS = r"([\p{Lu}\p{Ll}\p{Lt}]+|[^\p{Lu}\p{Ll}\p{Lt}]+)"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_blanks(c: Column | str) -> Column:
    """Remove leading/trailing Unicode blanks (``trim`` alone only removes spaces).

    ``btrim`` with a character set is a plain scan from both ends — no regex.
    """
    return F.btrim(_col(c), F.lit(BLANK_CHARS))


def collapse_blanks(c: Column | str) -> Column:
    """Replace every run of blanks with one space."""
    c = _col(c)
    return F.when(c.rlike(_NEEDS_COLLAPSE), F.regexp_replace(c, _RUN, " ")).otherwise(c)


def blank_to_null(c: Column | str) -> Column:
    c = _col(c)
    return F.when(c != "", c)


def is_all_upper(c: Column | str) -> Column:
    """True when the text has cased letters and all of them are upper case."""
    c = _col(c)
    return (F.upper(c) == c) & (F.lower(c) != c)


def title_case(c: Column | str) -> Column:
    """Capitalise the first letter of every run of letters, lower-case the rest.

    ``initcap`` alone splits words on spaces only ("Spider-man"); splitting into
    letter / non-letter runs first gives "Spider-Man", "L'Amour", "2Nd".
    """
    runs = F.regexp_extract_all(_col(c), F.lit(_CASED_RUNS), 1)
    return F.array_join(F.transform(runs, lambda r: F.initcap(r)), "")


def normalise_title(c: Column | str) -> Column:
    """Strip, collapse blanks, empty -> null."""
    return blank_to_null(collapse_blanks(strip_blanks(c)))


def title_if_upper(t: Column | str) -> Column:
    """Title-case a normalised title only when it is written wholly in capitals."""
    t = _col(t)
    return F.when(is_all_upper(t), title_case(t)).otherwise(t)


def clean_title(c: Column | str) -> Column:
    """``title_if_upper(normalise_title(c))`` as one expression.

    Inside a DataFrame prefer two projections (see ``operators.clean``): the
    normalised title is referenced four times and Catalyst keeps an expensive
    expression in its own projection instead of repeating it.
    """
    return title_if_upper(normalise_title(c))


def clean_token(c: Column | str, upper: bool = False) -> Column:
    """Strip, optionally upper-case, empty -> null."""
    t = strip_blanks(c)
    if upper:
        t = F.upper(t)
    return blank_to_null(t)
