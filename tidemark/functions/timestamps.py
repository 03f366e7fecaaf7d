"""ISO-8601 text. The offset is part of the value, so it stays text throughout."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

DATE = r"\d{4}-\d{2}-\d{2}"
CLOCK = r"(?:[01]\d|2[0-3]):[0-5]\d:[0-5]\d"
OFFSET = r"(?:[+-](?:[01]\d|2[0-3]):[0-5]\d)"
NORMAL = rf"^{DATE}T{CLOCK}(?:\.\d{{6}})?{OFFSET}?$"
PLAIN = rf"^{DATE}T{CLOCK}(?:Z|\+(?:[01]\d|2[0-3]):[0-5]\d)?$"

# Rewrites that fill in what a shorter or looser form leaves out, in this order.
FILL_IN = [
    (rf"^({DATE}).(\d{{2}})([+-].*)?$", "$1T$2:00:00$3"),
    (rf"^({DATE}).(\d{{2}}:\d{{2}})([+-].*)?$", "$1T$2:00$3"),
    (rf"^({DATE}).(\d{{2}}:\d{{2}}:\d{{2}})", "$1T$2"),
    (r"(T[^+-]*[+-]\d{2})(\d{2})$", "$1:$2"),
    (r"[.,](?<digits>\d+)", ".${digits}000000"),
    (r"\.(\d{6})\d*", ".$1"),
    (r"\.000000", ""),
    (r"(T.*)-00:00$", "$1+00:00"),
]


# Forms without separators, rewritten to those with.
SPREAD = [
    (r"^(\d{4})(\d{2})(\d{2})(?=$|\D)", "$1-$2-$3"),
    (rf"^({DATE}\D)(\d{{2}})(\d{{2}})(\d{{2}})(?=$|\D)", "$1$2:$3:$4"),
    (rf"^({DATE}\D)(\d{{2}})(\d{{2}})(?=$|\D)", "$1$2:$3"),
]
WEEK = r"^(\d{4})(?:-W(\d{2})(?:-([1-7]))?|W(\d{2})([1-7])?)(?=$|\D)"


def _week_as_date(value: Column) -> Column:
    """Week dates as calendar dates; weeks that a year does not have stay as they are."""
    part = lambda i: F.regexp_extract(value, WEEK, i)
    year = part(1).try_cast("int")
    week = F.concat(part(2), part(4)).try_cast("int")
    day = F.coalesce(F.concat(part(3), part(5)).try_cast("int"), F.lit(1))
    fourth = F.make_date(year, F.lit(1), F.lit(4))
    monday = F.date_sub(fourth, F.weekday(fourth))
    date = F.date_add(monday, (week - 1) * 7 + day - 1)
    rest = F.regexp_replace(value, WEEK, "")
    real = value.rlike(WEEK) & (week > 0) & (F.weekofyear(date) == week)
    return F.when(real, F.concat(date.cast("string"), rest)).otherwise(value)


def _real_date(value: Column) -> Column:
    return value.rlike(rf"^{DATE}") & F.substring(value, 1, 10).try_cast("date").isNotNull()


def _bound(value: Column, rule: Callable[[Column], Column]) -> Column:
    """`rule` of a value that is worked out once. It runs outside generated code, which
    keeps the code of a mapper with many timestamps small."""
    return F.get(F.transform(F.array(value), rule), F.lit(0))


def _spread(value: Column) -> Column:
    for pattern, replacement in SPREAD:
        value = F.regexp_replace(value, F.lit(pattern), F.lit(replacement))
    return value


def _filled_in(value: Column) -> Column:
    value = F.replace(value, F.lit("Z"), F.lit("+00:00"))
    for pattern, replacement in FILL_IN:
        value = F.regexp_replace(value, F.lit(pattern), F.lit(replacement))
    return F.nullif(F.regexp_extract(value, NORMAL, 0), F.lit(""))


def _loose(value: Column) -> Column:
    """Any form but the plain one; text that is no timestamp stays."""

    def finish(spread: Column) -> Column:
        return (
            F.when(~_real_date(spread), value)
            .when(F.length(spread) == 10, F.concat(spread, F.lit("T00:00:00")))
            .otherwise(F.coalesce(_filled_in(spread), value))
        )

    return _bound(_spread(_week_as_date(value)), finish)


def iso_normalized(value: Column) -> Column:
    """Z becomes +00:00 and missing parts are filled; text that is no timestamp stays."""
    return (
        F.when(F.coalesce(value, F.lit("")) == "", F.lit(""))
        .when(value.rlike(PLAIN) & _real_date(value), F.replace(value, F.lit("Z"), F.lit("+00:00")))
        .otherwise(_bound(value, _loose))
    )


def iso_passthrough(value: Column) -> Column:
    return F.coalesce(value, F.lit(""))
