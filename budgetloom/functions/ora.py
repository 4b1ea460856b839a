"""Column helpers that follow Oracle's text and number rules with built-in Spark functions.

Oracle has no empty string: '' is NULL. The helpers here may return '' in between, since '' and NULL
behave alike under trim, replace, substr and concatenation; wrap a finished value in ``nz`` before it is
stored, tested for NULL, or compared with a negation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

WHOLE = T.DecimalType(38, 10)


def nz(c: Column) -> Column:
    """'' becomes NULL."""
    return F.when(c != "", c)


def cat(*parts: Column) -> Column:
    """``||``: NULL parts count as ''; all parts NULL gives NULL."""
    return nz(F.concat_ws("", *parts))


def mid(s: Column, pos: int | Column, n: int | Column | None = None) -> Column:
    """SUBSTR from a position known to be 1 or more; n < 1 gives nothing."""
    return F.substr(s, F.lit(pos), None if n is None else F.lit(n))


def substr(s: Column, pos: int | Column, n: int | Column | None = None) -> Column:
    """SUBSTR: position 0 means 1, a negative one counts from the end, one beyond either end or n < 1 gives nothing."""
    if isinstance(pos, int) and pos >= 0:
        return mid(s, max(pos, 1), n)
    p = F.lit(pos)
    start = F.when(p < 0, F.length(s) + p + 1).when(p == 0, F.lit(1)).otherwise(p)
    return F.when(start >= 1, mid(s, start, n))


def instr_last(s: Column, ch: str, nth: int = 1) -> Column:
    """Position of the nth-last ``ch`` (one character), 0 when there are fewer."""
    return F.length(s) - F.length(F.substring_index(s, ch, -nth))


def delete(s: Column, text: str) -> Column:
    """REPLACE with no replacement."""
    return F.replace(s, F.lit(text), F.lit(""))


def bare(s: Column) -> Column:
    """Text without single quotes and outer spaces."""
    return F.trim(delete(s, "'"))


def to_whole(s: Column) -> Column:
    """TO_NUMBER into an INTEGER for text that is not NULL: rounds half away from zero, raises on text that is no number."""
    bad = F.raise_error(F.concat(F.lit("not a number: "), s)).cast(WHOLE)
    return F.round(F.coalesce(s.try_cast(WHOLE), bad)).cast("long")
