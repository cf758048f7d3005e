"""String cleaning that behaves the same in Spark and in the SQL oracle.

Spark's ``trim`` removes only U+0020. The reporting SQL dialect's ``trim``
removes every Unicode *space separator* (category Zs: space, no-break space,
the U+2000 block, U+202F, U+205F, U+3000, U+1680) and keeps tab, CR and LF.
``ztrim`` reproduces that, so `' MWh '` and `'MWh '` clean identically.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EDGE_SPACES = r"^\p{Zs}+|\p{Zs}+$"


def ztrim(c: Column | str) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.regexp_replace(col, _EDGE_SPACES, "")


def blank_to_null(c: Column | str) -> Column:
    """``nullif(trim(x), '')``."""
    t = ztrim(c)
    return F.when(t != F.lit(""), t)
