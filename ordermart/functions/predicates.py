"""Row predicates."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, functions as F

from .clean import _col, strip_all, trim_spaces

# Fixed value: the e-mail pattern of the source project.  Its "$" is the
# end of the text, so in Java it is written "\z" (Java "$" also matches
# before a final newline).
EMAIL_PATTERN = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"
EMAIL_RE = EMAIL_PATTERN[:-1] + r"\z"


def is_blank(c) -> Column:
    """``c IS NULL OR TRIM(c) = ''``."""
    return _col(c).isNull() | (trim_spaces(c) == "")


def is_blank_stripped(c) -> Column:
    """missing, or empty after a full whitespace strip."""
    return _col(c).isNull() | (strip_all(c) == "")


def any_of(preds) -> Column:
    preds = list(preds)
    return reduce(or_, preds) if preds else F.lit(False)


def any_blank(cols) -> Column:
    return any_of(is_blank(c) for c in cols)


def email_invalid(c) -> Column:
    """null, or not of the e-mail shape."""
    return _col(c).isNull() | ~_col(c).rlike(EMAIL_RE)


def over_length(c, limit: int) -> Column:
    """VARCHAR(n) limit, counted in bytes."""
    return F.octet_length(_col(c)) > limit
