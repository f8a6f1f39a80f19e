"""Small text helpers shared by the other function modules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character that counts as white space when text is stripped.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def strip(text: Column | str) -> Column:
    """Drop white space of every kind at both ends (``trim`` drops blanks only)."""
    return F.btrim(as_column(text), F.lit(WHITESPACE))


def shorten(text: Column | str, length: int | None) -> Column:
    """The first ``length`` characters; the whole text without a length."""
    return as_column(text) if length is None else F.substring(as_column(text), 1, length)
