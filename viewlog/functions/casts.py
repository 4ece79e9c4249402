"""Casts that give NULL for bad input under ANSI mode.

The original pipeline ran with non-ANSI casts, which return NULL for bad
text. Spark 4 raises instead, so every cast here is a ``try_`` form, and the
integer cast keeps the old behaviour of truncating a decimal text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from viewlog.schema import SESSION_TS_PATTERN

# Leading/trailing whitespace and control characters, as the old cast trimmed.
_EDGE_CHARS = "".join(chr(i) for i in range(0x21))


def legacy_long(c: Column) -> Column:
    """String -> BIGINT like the old non-ANSI cast.

    '12.7' -> 12, '-3.' -> -3, '.5' -> 0, '1e3' -> NULL, 'abc' -> NULL,
    out-of-range -> NULL. Plain integers take the direct cast, which trims
    such characters itself; only text that fails it is trimmed and matched
    against the decimal pattern.
    """
    v = F.trim(c, F.lit(_EDGE_CHARS))
    whole = F.substring_index(v, ".", 1)
    truncated = (F.when(whole.isin("", "+", "-"), F.lit(0).cast("bigint"))
                  .otherwise(whole.try_cast("bigint")))
    return F.coalesce(c.try_cast("bigint"),
                      F.when(v.rlike(r"^[+-]?[0-9]*[.][0-9]*$"), truncated))


def try_float(c: Column) -> Column:
    return c.try_cast("float")


def session_timestamp(menu: Column) -> Column:
    """First ':YYYY:MM:DD:HH:MM:SS' in SessionMainMenu as TIMESTAMP_NTZ.

    No match, or an impossible date or time, gives NULL. The matched text has
    fixed positions, so it is rearranged with substrings, not another regex.
    """
    raw = F.regexp_extract(menu, SESSION_TS_PATTERN, 1)

    def part(pos: int, n: int) -> Column:
        return F.substring(raw, pos, n)

    text = F.concat(part(1, 4), F.lit("-"), part(6, 2), F.lit("-"), part(9, 2), F.lit(" "),
                    part(12, 2), F.lit(":"), part(15, 2), F.lit(":"), part(18, 2))
    return F.when(raw != "", text).try_cast("timestamp_ntz")
