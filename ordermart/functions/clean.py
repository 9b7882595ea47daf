"""Cleaning functions: ``Column -> Column``, all JVM-side built-ins.

None needs a Python UDF.  All but ``initcap_words``, whose ``transform``
lambda Spark interprets, stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The whitespace set of Python's ``str.strip()`` /
# ``str.isspace()``: \t \n \x0B \f \r, the separators \x1C-\x1F, space,
# \x85, \xA0, U+1680, U+2000-U+200A, U+2028, U+2029, U+202F, U+205F, U+3000,
# as a regex class of RE2 (DuckDB).
PY_WHITESPACE_CLASS_RE2 = (
    "[\\t\\n\\x0B\\f\\r\\x1C-\\x1F \\x85\\xA0\\x{1680}\\x{2000}-\\x{200A}"
    "\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]"
)
# The same set as plain characters, for btrim (no regex engine per row).
PY_WHITESPACE_CHARS = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
                       + "".join(chr(c) for c in range(0x2000, 0x200B))
                       + "\u2028\u2029\u202f\u205f\u3000")

# POSIX [[:space:]]: space, \t, \n, \x0B, \f, \r.  Java's \p{Space} is the
# same set (Java reads a bare "[[:space:]]" as the letters ":space").
_SPACE_RUN_RE = "\\p{Space}+"

# A word for INITCAP is a run of ASCII letters and digits; anything else
# breaks words ("anne-marie o'neil" -> "Anne-Marie O'Neil").
_WORD_OR_GAP_RE = "([A-Za-z0-9]+|[^A-Za-z0-9]+)"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trim_spaces(c) -> Column:
    """SQL TRIM, which removes spaces only (not tabs or newlines)."""
    return F.trim(_col(c))


def collapse_whitespace(c) -> Column:
    """Each run of POSIX whitespace becomes one space."""
    return F.regexp_replace(_col(c), _SPACE_RUN_RE, " ")


def initcap_words(c) -> Column:
    """INITCAP where any non-alphanumeric character breaks words.

    Lower-case the text, split it into alternating word / gap tokens and
    upper-case the first character of each word token.
    """
    tokens = F.regexp_extract_all(F.lower(_col(c)), F.lit(_WORD_OR_GAP_RE), 1)
    cap = F.transform(
        tokens,
        lambda t: F.when(t.rlike("^[A-Za-z0-9]"),
                         F.concat(F.upper(F.substring(t, 1, 1)), F.substr(t, F.lit(2))))
        .otherwise(t))
    return F.when(_col(c).isNull(), F.lit(None).cast("string")).otherwise(F.array_join(cap, ""))


def clean_text(c) -> Column:
    """P1 + P2 + P3: INITCAP(REGEXP_REPLACE(TRIM(c), space-run, ' '))."""
    return initcap_words(collapse_whitespace(trim_spaces(c)))


def lower_trim(c) -> Column:
    """LOWER(TRIM(c))."""
    return F.lower(trim_spaces(c))


def strip_all(c) -> Column:
    """P5: remove leading/trailing whitespace like Python ``str.strip()``.

    ``btrim`` with the character set works on the UTF-8 bytes directly.
    """
    return F.btrim(_col(c), F.lit(PY_WHITESPACE_CHARS))


def month_bucket(c) -> Column:
    """DATE_FORMAT(d, '%Y-%m')."""
    return F.date_format(_col(c), "yyyy-MM")
