"""Scalar rules used by the topic specs.

All of them give the same rows with ANSI mode on or off and in any session
time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hitloom.plans.contract import BEFORE_PATTERN, DATE_RANGE_SEPARATOR, POINT_PATTERN

_DAY_SECONDS = 86400
# What a cast to integer accepts, blanks and control characters around it included.
_INTEGER_TEXT = r"^[\s\p{Cntrl}]*[+-]?[0-9]+[\s\p{Cntrl}]*$"


def date_range_bounds(text: Column) -> tuple[Column, Column]:
    """Both ends of a written date range.

    "X to Y" gives (X, Y), "X" gives (X, null), and a text that says "Before"
    has no start and is its own end.
    """
    open_start = text.like(BEFORE_PATTERN)
    ends = F.split(text, DATE_RANGE_SEPARATOR)
    start = F.when(~open_start, F.get(ends, F.lit(0)))
    end = F.when(open_start, text).otherwise(F.get(ends, F.lit(1)))
    return start, end


def clean_duration(seconds: Column) -> Column:
    """Seconds without infinities (0 instead) and without NaN (null instead); text that is no number is null."""
    value = seconds.try_cast("double")
    return (
        F.when(value.isin(float("inf"), float("-inf")), F.lit(0.0))
        .when(F.isnan(value), F.lit(None).cast("double"))
        .otherwise(value)
    )


def rounded_int(value: Column) -> Column:
    """Nearest integer, halves away from zero; null where it does not fit or is no number."""
    return F.round(value.try_cast("double"), 0).try_cast("int")


def to_int(value: Column) -> Column:
    """Integer value of an id, null where it has none.

    Text that is no integer is told apart by its characters first: a failing
    ``try_cast`` costs some twenty microseconds per row, which would make bad
    ids forty times as dear as good ones. ``typeof`` is folded at planning, so
    numbers are only cast.
    """
    is_text = F.typeof(value) == "string"
    return F.when(~is_text | value.cast("string").rlike(_INTEGER_TEXT), value.try_cast("int"))


def clock_time(seconds: Column) -> Column:
    """Whole seconds as ``HH:mm:ss``, starting again at each full day.

    Written out as arithmetic because ``from_unixtime`` would shift the result
    by the session time zone.
    """
    of_day = F.pmod(seconds.cast("bigint"), F.lit(_DAY_SECONDS))

    def two_digits(n: Column) -> Column:
        return F.lpad(n.cast("int").cast("string"), 2, "0")

    return F.concat(
        two_digits(F.floor(of_day / 3600)),
        F.lit(":"),
        two_digits(F.floor(of_day % 3600 / 60)),
        F.lit(":"),
        two_digits(of_day % 60),
    )


def joined_key(*parts: Column) -> Column:
    """The parts written one after another; null if any part is null."""
    return F.concat(*(part.cast("string") for part in parts))


def url(prefix: str, identifier: Column) -> Column:
    """``prefix`` followed by the identifier; null without one."""
    return joined_key(F.lit(prefix), identifier)


def point_coordinates(wkt: Column) -> tuple[Column, Column]:
    """Longitude and latitude of a WKT point, as written; '' if there is none."""
    return F.regexp_extract(wkt, POINT_PATTERN, 1), F.regexp_extract(wkt, POINT_PATTERN, 2)


def hash_key(identifier: Column) -> Column:
    """SHA-256 of the identifier in lower-case hex."""
    return F.sha2(identifier.cast("string"), 256)


def load_timestamp() -> Column:
    """Start of the query that writes the row, the same for all its rows."""
    return F.current_timestamp()
