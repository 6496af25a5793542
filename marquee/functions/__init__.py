from marquee.functions.dates import parse_date
from marquee.functions.guards import MissingColumnsError, require_columns, shape
from marquee.functions.numeric import first_digit_run, is_digits, to_double, to_int_id
from marquee.functions.text import (blank_to_null, clean_title, clean_token, collapse_blanks,
                                    is_all_upper, normalise_title, strip_blanks, title_case,
                                    title_if_upper)

__all__ = [
    "parse_date", "MissingColumnsError", "require_columns", "shape", "first_digit_run",
    "is_digits", "to_double", "to_int_id", "blank_to_null", "clean_title", "clean_token",
    "collapse_blanks", "is_all_upper", "normalise_title", "strip_blanks", "title_case",
    "title_if_upper",
]
