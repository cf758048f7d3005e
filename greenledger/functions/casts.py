"""Safe casts from raw strings, with the reporting dialect's grammar.

Raw submissions arrive as strings. A value counts as numeric, a date or a
timestamp exactly when the reporting SQL dialect (the one the DuckDB oracle
runs) accepts it, so a row quarantined in one engine is quarantined in the
other. Spark's own casts disagree on several inputs, e.g. Spark reads
``'1d'`` as 1.0 and ``'2024-01'`` as a date, and rejects ``'1_000'`` and
``'1.5'`` as an int. Each helper therefore guards the input with an
anchored pattern of the accepted grammar, normalises it, and only then
casts. Everything stays a JVM expression. The canonical spelling (``12``,
``2024-01-05``, ``2024-01-05 08:00:00``) takes a fast path inside
whole-stage codegen; every other spelling goes through the full grammar
inside a one-element ``transform`` lambda. Lambdas are evaluated
interpreted, so the rarely used general code does not inflate the
generated method (a method too large for the JIT would slow the whole
fused stage several-fold).

Fixed grammar decisions (must stay equal to the oracle dialect):
- whitespace around numbers: ASCII space, tab, LF, CR, VT, FF;
- digit groups may be separated by single underscores (``1_000``);
- doubles also accept ``nan``, ``inf``, ``infinity`` with optional sign;
- integers accept decimals and exponents and round half away from zero,
  and accept ``0x`` hexadecimal;
- dates are ``Y-M-D`` (or ``Y/M/D``) with 1-4 digit year and 1-2 digit
  month and day, optionally followed by whitespace or a valid time part;
- timestamps are such a date, optionally followed by ``T`` or spaces and
  ``H:MM[:SS[.ffffff]]``, an optional ``Z``/``+hh[:mm]``/``UTC`` suffix
  (kept as wall time) and trailing whitespace; ``24:00:00`` is the next day.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_WS = r"[ \t\n\r\x0B\f]"
_DIGITS = r"\d+(?:_\d+)*"
_NUMBER = (rf"^{_WS}*[+-]?(?:{_DIGITS}(?:\.(?:{_DIGITS})?)?|\.{_DIGITS})"
           rf"(?:[eE][+-]?\d+)?{_WS}*$")
_INTEGER = rf"^{_WS}*[+-]?{_DIGITS}{_WS}*$"
_HEX = rf"^{_WS}*0[xX]([0-9a-fA-F]+){_WS}*$"
_SPECIAL = rf"(?i)^{_WS}*([+-]?)(nan|inf|infinity){_WS}*$"
_STRIP = rf"^{_WS}+|{_WS}+$"
# Fast paths: canonical spellings both engines read identically.
_PLAIN_NUMBER = r"^-?\d{1,15}(?:\.\d{1,15})?$"
_PLAIN_INT = r"^-?\d{1,18}$"
_PLAIN_DATE = r"^\d{4}-\d{2}-\d{2}$"
_PLAIN_TS = r"^\d{4}-\d{2}-\d{2} (?:[01]\d|2[0-3]):[0-5]\d:[0-5]\d$"

_DATE_HEAD = rf"^{_WS}*" + r"(\d{1,4})([-/])(\d{1,2})\2(\d{1,2})"
_DATE = _DATE_HEAD + r"[\s\p{Zs}]*$"
# A date followed by a time part that is itself valid (hour 0-23 or exactly
# midnight written as 24:00:00, minutes and seconds 0-59).
_DATE_TIME = (_DATE_HEAD + r"(?:T| +)(?:(?:[01]?\d|2[0-3]):[0-5]\d(?::[0-5]\d(?:\.\d+)?)?"
              r"|24:00(?::00(?:\.0+)?)?)(?:Z|[+-]\d{2}(?::?\d{2})?|\s*UTC)?[\s\p{Zs}]*$")
_TS = (_DATE_HEAD + r"(?:$|(?:T| +)(\d{1,2}):(\d{2})(?::(\d{2})(?:\.(\d{1,6})\d*)?)?"
       r"(?:Z|[+-]\d{2}(?::?\d{2})?|\s*UTC)?[\s\p{Zs}]*$)")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _rare(s: Column, general) -> Column:
    """``general(s)`` evaluated through a one-element lambda (see above)."""
    return F.transform(F.array(s), general)[0]


def _clean_number(s: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(s, _STRIP, ""), "_", "")


def _general_double(s: Column) -> Column:
    sign = F.regexp_extract(s, _SPECIAL, 1)
    word = F.lower(F.regexp_extract(s, _SPECIAL, 2))
    special = (F.when(word == "nan", F.lit(float("nan")))
               .when(sign == "-", F.lit(float("-inf")))
               .otherwise(F.lit(float("inf"))))
    return (F.when(s.rlike(_NUMBER), _clean_number(s).try_cast("double"))
            .when(s.rlike(_SPECIAL), special))


def duck_double(c: Column | str) -> Column:
    """``try_cast(x AS DOUBLE)`` with the oracle dialect's grammar."""
    s = _col(c)
    return (F.when(s.rlike(_PLAIN_NUMBER), s.try_cast("double"))
            .otherwise(_rare(s, _general_double)))


def _general_bigint(s: Column) -> Column:
    as_double = _clean_number(s).try_cast("double")
    return (F.when(s.rlike(_INTEGER), _clean_number(s).try_cast("bigint"))
            .when(s.rlike(_NUMBER), F.round(as_double, 0).try_cast("bigint"))
            .when(s.rlike(_HEX),
                  F.conv(F.regexp_extract(s, _HEX, 1), 16, 10).try_cast("bigint")))


def duck_bigint(c: Column | str) -> Column:
    """``try_cast(x AS BIGINT)``: exact for integers, decimals round half away
    from zero, hexadecimal accepted, out of range gives NULL."""
    s = _col(c)
    return (F.when(s.rlike(_PLAIN_INT), s.try_cast("bigint"))
            .otherwise(_rare(s, _general_bigint)))


def duck_int(c: Column | str) -> Column:
    """``try_cast(x AS INTEGER)``."""
    return duck_bigint(c).try_cast("int")


_TZ_AFTER_TIME = r"(:\d{2}(?::\d{2}(?:\.\d+)?)?)(?:Z|[+-]\d{2}(?::?\d{2})?|\s*UTC)"
_PARTS = r"[-/T :.\s\p{Zs}]+"


def _parts(s: Column) -> Column:
    """Numeric fields of a string already validated by ``_DATE``,
    ``_DATE_TIME`` or ``_TS``: [year, month, day, hour, minute, second,
    fraction], as many as present. One replace and one split keep the
    generated code small (it shares a stage with the whole rule set)."""
    core = F.regexp_replace(F.regexp_replace(s, _TZ_AFTER_TIME, "$1"), r"^[\s\p{Zs}]+", "")
    return F.split(core, _PARTS)


def _field(parts: Column, i: int, default: int | None = None) -> Column:
    v = F.try_element_at(parts, F.lit(i)).try_cast("int")
    return v if default is None else F.coalesce(v, F.lit(default))


def _date_of(parts: Column) -> Column:
    return F.try_make_timestamp_ntz(_field(parts, 1), _field(parts, 2), _field(parts, 3),
                                    F.lit(0), F.lit(0), F.lit(0)).cast("date")


def duck_date(c: Column | str) -> Column:
    """``try_cast(x AS DATE)``; impossible dates (Feb 30) give NULL. A time
    part is allowed but must itself be valid; it is then dropped."""
    s = _col(c)
    return (F.when(s.rlike(_PLAIN_DATE), s.try_cast("date"))
            .otherwise(_rare(s, lambda x: F.when(x.rlike(_DATE) | x.rlike(_DATE_TIME),
                                                 _date_of(_parts(x))))))


def _general_timestamp(s: Column) -> Column:
    p = _parts(s)
    hh, mi, ss = _field(p, 4, 0), _field(p, 5, 0), _field(p, 6, 0)
    frac_digits = F.substring(F.coalesce(F.try_element_at(p, F.lit(7)), F.lit("0")), 1, 6)
    frac = F.concat(F.lit("0."), frac_digits).cast("decimal(7,6)")
    secs = (ss.cast("decimal(8,6)") + frac).cast("decimal(8,6)")
    next_day = (hh == 24) & (mi == 0) & (secs == 0)
    base = F.try_make_timestamp_ntz(_field(p, 1), _field(p, 2), _field(p, 3),
                                    F.when(next_day, F.lit(0)).otherwise(hh), mi, secs)
    general = F.when(next_day, base + F.expr("INTERVAL 1 DAY")).otherwise(base)
    return F.when(s.rlike(_TS), general)


def duck_timestamp(c: Column | str) -> Column:
    """``try_cast(x AS TIMESTAMP)`` as a Spark ``TIMESTAMP_NTZ``."""
    s = _col(c)
    return (F.when(s.rlike(_PLAIN_TS), s.try_cast("timestamp_ntz"))
            .otherwise(_rare(s, _general_timestamp)))


def month_start_of_period(c: Column | str) -> Column:
    """``try_cast(period || '-01' AS DATE)``: ``'2024-01'`` -> 2024-01-01,
    while ``'2024'``, ``'2024-Q1'`` and NULL give NULL."""
    return duck_date(F.concat(_col(c), F.lit("-01")))
