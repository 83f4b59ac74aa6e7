"""Text and date parsing used by the ingest jobs (all JVM-side expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from demandlens.functions.util import to_col

# The characters Python's str.strip() removes (str.isspace()).
# Spark's trim() only removes spaces, so "\r" from CRLF files would survive it.
WHITESPACE_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Month / day / two-digit year as accepted by the "%m/%d/%y" format.
MDY_PATTERN = r"\A(1[0-2]|0[1-9]|[1-9])/(3[01]|[12][0-9]|0[1-9]|[1-9]| [1-9])/([0-9]{2})\z"
# Two-digit years below this value are 20xx, the others 19xx.
CENTURY_PIVOT = 69

# Fixed values of the sectioned interest export: header prefix, the separator
# inside the date range, the score written for "less than one", and its value.
HEADER_PREFIX = "Region"
RANGE_SEPARATOR = " - "
BELOW_ONE_TEXT = "<1"
BELOW_ONE_SCORE = 1
FIRST_PARENTHESES = r"\(([^)]+)\)"
INTEGER_PATTERN = r"\A[+-]?[0-9]+\z"


def strip_ws(col) -> Column:
    """Python-style strip(): remove leading and trailing whitespace incl. CR and tabs
    (a character-set trim, no regular expression)."""
    return F.btrim(to_col(col), F.lit(WHITESPACE_CHARS))


def lstrip_ws(col) -> Column:
    return F.ltrim(to_col(col), F.lit(WHITESPACE_CHARS))


def parse_mdy(col) -> Column:
    """``m/d/yy`` text to DATE; NULL when the text does not match or the day does not exist."""
    c = to_col(col)
    matched = c.rlike(MDY_PATTERN)
    # Defaults keep the arithmetic valid on non-matching text (no exceptions on the hot path).
    month = F.coalesce(F.regexp_extract(c, MDY_PATTERN, 1).try_cast("int"), F.lit(1))
    day = F.coalesce(F.trim(F.regexp_extract(c, MDY_PATTERN, 2)).try_cast("int"), F.lit(1))
    yy = F.coalesce(F.regexp_extract(c, MDY_PATTERN, 3).try_cast("int"), F.lit(0))
    year = F.when(yy < CENTURY_PIVOT, yy + 2000).otherwise(yy + 1900)
    # Day d of the month is the first of the month plus d - 1 days; it is a real
    # date only if that stays in the same month (2/30 rolls into March).
    candidate = F.date_add(F.make_date(year, month, F.lit(1)), day - 1)
    return F.when(matched & (F.month(candidate) == month), candidate)


def is_section_header(raw_line) -> Column:
    """A header starts with "Region" (no leading blanks) and holds "(", ")" and " - "."""
    c = to_col(raw_line)
    return (
        c.startswith(HEADER_PREFIX)
        & c.contains("(")
        & c.contains(")")
        & c.contains(RANGE_SEPARATOR)
    )


def header_keyword(raw_line) -> Column:
    """Keyword of a header line, or NULL when the header carries none (":" missing or blank).

    The keyword is the text after the first seven characters ("Region,") up to the
    first ":", stripped and lower-cased.
    """
    c = to_col(raw_line)
    body = strip_ws(F.substring(c, 8, 1 << 30))
    keyword = F.lower(strip_ws(F.substring_index(body, ":", 1)))
    return F.when(c.contains(":") & c.startswith(HEADER_PREFIX) & (keyword != ""), keyword)


def parse_score(col) -> Column:
    """Interest score text to BIGINT: "<1" is 1, an integer is itself, anything else NULL."""
    c = to_col(col)
    return (
        F.when(c == BELOW_ONE_TEXT, F.lit(BELOW_ONE_SCORE).cast("bigint"))
        .when(c.rlike(INTEGER_PATTERN), c.try_cast("bigint"))
    )


def split_last(col, sep: str = ",") -> Column:
    """struct(head, tail) split at the last ``sep``; NULL when ``sep`` does not occur."""
    c = to_col(col)
    tail = F.substring_index(c, sep, -1)
    head = c.substr(F.lit(1), F.length(c) - F.length(tail) - F.lit(len(sep)))
    return F.when(c.contains(sep), F.struct(head.alias("head"), tail.alias("tail")))
