"""Column-level helpers (pure ``Column -> Column``), JVM-side only."""

from .casts import (duck_bigint, duck_date, duck_double, duck_int,
                    duck_timestamp, month_start_of_period)
from .text import blank_to_null, ztrim

__all__ = [
    "duck_bigint", "duck_date", "duck_double", "duck_int", "duck_timestamp",
    "month_start_of_period", "blank_to_null", "ztrim",
]
