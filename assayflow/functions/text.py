"""Text clean-up."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every separator that may break a line, plus ASCII controls. The non-breaking spaces
# (U+00A0, U+2007, U+202F) are not whitespace here.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2008\u2009\u200a\u2028\u2029\u205f\u3000"
)


def trim_whitespace(col: Column) -> Column:
    """Strip all whitespace from both ends; Spark's plain ``trim`` strips spaces only."""
    return F.trim(col, F.lit(WHITESPACE))


def blank_to_null(col: Column) -> Column:
    """Turn the empty string into NULL and leave everything else alone."""
    return F.nullif(col, F.lit(""))
