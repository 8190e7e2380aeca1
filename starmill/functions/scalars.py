"""Scalar column expressions; all stay inside code generation."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, functions as F


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def time_literal(value: datetime) -> Column:
    """A timestamp without zone, written as text so that no time zone can shift it."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def sql_literal(value: object) -> str:
    """``value`` as SQL text, to be cast to its column's type."""
    if value is None:
        return "NULL"
    text = value.isoformat(sep=" ") if isinstance(value, datetime) else str(value)
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def null_tolerant_concat(*parts: Column | str, sep: str = " ") -> Column:
    """Join strings with ``sep``; a NULL part counts as the empty string, its separator stays."""
    texts = [F.coalesce(_col(p).cast("string"), F.lit("")) for p in parts]
    pieces = [texts[0]]
    for text in texts[1:]:
        pieces += [F.lit(sep), text]
    return F.concat(*pieces)


def default_to(value: Column | str, default) -> Column:
    return F.coalesce(_col(value), F.lit(default))


def date_key(day: Column | str) -> Column:
    """A date or timestamp as the integer yyyyMMdd."""
    day = _col(day)
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def differs(left: Column, right: Column, null_safe: bool = True) -> Column:
    """True when the values differ.

    With ``null_safe=False`` a NULL on either side never counts as a change, which is what a
    plain ``<>`` does.
    """
    if null_safe:
        return ~left.eqNullSafe(right)
    return F.coalesce(left != right, F.lit(False))


def any_differs(pairs: Mapping[Column, Column] | Iterable[tuple[Column, Column]],
                null_safe: bool = True) -> Column:
    pairs = pairs.items() if isinstance(pairs, Mapping) else pairs
    return reduce(lambda a, b: a | b, [differs(x, y, null_safe) for x, y in pairs], F.lit(False))


def _seconds(ts: Column) -> Column:
    """Whole seconds since 1970 of a wall-clock time.

    Built from calendar fields, so clock changes of the session's time zone play no part.
    """
    days = F.datediff(ts.cast("date"), F.lit("1970-01-01").cast("date")).cast("long")
    return days * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def seconds_between(start: Column | str, end: Column | str) -> Column:
    """Second boundaries crossed from ``start`` to ``end``; NULL when either is NULL."""
    return (_seconds(_col(end)) - _seconds(_col(start))).cast("long")


def minute_index(ts: Column | str, minutes: int) -> Column:
    """Number of the ``minutes``-wide slot that holds ``ts``; grows with ``ts``."""
    return F.floor(_seconds(_col(ts)) / F.lit(minutes * 60)).cast("long")
