"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.fixed_values import PREVIEW_CHARS

# Every character that counts as white space at the ends of a line.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009"
    "\u200a\u2028\u2029\u202f\u205f\u3000"
)


def strip(text: Column) -> Column:
    """Drop white space (any Unicode kind) from both ends."""
    return F.btrim(text, F.lit(BLANKS))


def lines(text: Column) -> Column:
    """Array of the lines of a text, whichever line ending it uses."""
    return F.split(text, r"\r\n|\r|\n")


def preview(text: Column, chars: int = PREVIEW_CHARS) -> Column:
    """The text itself, or its first ``chars`` characters followed by an ellipsis."""
    return F.when(F.char_length(text) > chars, F.concat(F.substring(text, 1, chars), F.lit("..."))).otherwise(text)


def utf8(text: Column) -> Column:
    return F.encode(text, "UTF-8")
