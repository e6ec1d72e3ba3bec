"""Flexible timestamp parsing without Python rows (CL8).

A value is recognised by its shape, rewritten to one canonical text of nine parts (year, month,
day, hour, minute, second, fraction, am/pm, zone) and assembled by `try_make_timestamp_ntz`. Nothing throws on bad input, so a column full of unparseable text
costs no exceptions. Values already in plain ISO form skip all of that through `try_cast`.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_HALF = r"(?:\s*([AaPp][Mm]))?"
# Zone names other than these three are read as naive, whatever they stand for.
_ZONE = r"(?:\s*([Zz]|[A-Z]{3,5}|[+-]\d{2}:?\d{2}|[+-]\d{2}))?$"
_HOUR_ALONE = r"(?=\s*[AaPp][Mm]|(?<=\d\d)$)"
_TIME = (
    r"(?:(?:\s*,\s*|\s+(?:at\s+)?|[Tt])(\d{1,2})"
    rf"(?::(\d{{1,2}})(?::(\d{{1,2}})(?:[.,](\d{{1,9}}))?)?|{_HOUR_ALONE}){_HALF})?{_ZONE}"
)
_DIGIT_TIME = rf"(\d{{2}})(\d{{2}})(?:(\d{{2}})(?:[.,](\d{{1,9}}))?)?{_HALF}{_ZONE}"
_SEP = r"[-/.]"
_ORDINAL = r"(?:st|nd|rd|th)?"
_YEARS = r"(\d{4}|\d{2})"

# Shape -> which captured groups hold year, month and day.
_SHAPES = (
    (rf"^(\d{{4}}){_SEP}(\d{{1,2}}){_SEP}(\d{{1,2}}){_TIME}", (1, 2, 3)),
    (rf"^(\d{{1,2}}){_SEP}(\d{{1,2}}){_SEP}{_YEARS}{_TIME}", (3, 1, 2)),
    (rf"^([A-Za-z]{{3,9}})\.?[\s-]+(\d{{1,2}}){_ORDINAL},?[\s-]+{_YEARS}{_TIME}", (3, 1, 2)),
    (rf"^(\d{{1,2}}){_ORDINAL}[\s-]+([A-Za-z]{{3,9}})\.?,?[\s-]+{_YEARS}{_TIME}", (3, 2, 1)),
    (rf"^(\d{{4}})(\d{{2}})(\d{{2}}){_TIME}", (1, 2, 3)),
    (rf"^(\d{{4}})(\d{{2}})(\d{{2}})(?:[Tt]|\s+)?{_DIGIT_TIME}", (1, 2, 3)),
    (rf"^(\d{{4}})-(\d{{2}})-(\d{{2}})(?:[Tt]|\s+){_DIGIT_TIME}", (1, 2, 3)),
)

# What may stand before a date: a weekday, which says nothing more, or the time of day.
_WEEKDAY = (
    r"^(?i:mon|tue|wed|thu|fri|sat|sun|monday|tuesday|wednesday|thursday|friday|saturday|sunday)"
    r"(?:\.?,\s*|\.?\s+)(?=\w)"
)
_TIME_FIRST = (
    r"^(\d{1,2}(?::\d{2}(?::\d{2}(?:[.,]\d{1,9})?)?(?:\s*[AaPp][Mm])?|\s*[AaPp][Mm]))"
    r"(?:\s*,\s*|\s+)(\w.*)$"
)

# Unit separator: stands between the parts of the canonical text.
_CUT = "\u001f"

_PLAIN_ISO = r"^\d{4}-\d{2}-\d{2}(?:[ T]\d{2}:\d{2}(?::\d{2}(?:\.\d{1,6})?)?(?:Z|\+00:00)?)?$"

# Month names.
_MONTHS = (
    "january", "february", "march", "april", "may", "june",
    "july", "august", "september", "october", "november", "december",
)


_MONTH_TABLE = ", ".join(
    f"'{spelling}', {number}"
    for number, name in enumerate(_MONTHS, start=1)
    for spelling in dict.fromkeys((name, name[:3]))
)

# From the canonical parts to a timestamp; NULL unless they make a valid one. Written as SQL
# because it is one fixed expression, used for every time column. Only parts that are digits are
# cast: a failing try_cast raises and catches an exception, which is far too slow per row.
_YEAR = """
CASE WHEN length(p[0]) > 2 THEN try_cast(p[0] AS int)
     ELSE try_cast(p[0] AS int) + 100 * cast(floor((year(current_date()) + 49 - try_cast(p[0] AS int)) / 100) AS int)
END"""
_MONTH = f"""
CASE WHEN p[1] < 'A' THEN try_cast(p[1] AS int)
     ELSE try_element_at(map({_MONTH_TABLE}, 'sept', 9), lower(p[1])) END"""
_DAY = "try_cast(p[2] AS int)"
_DAY_FIRST = f"(p[1] < 'A' AND {_MONTH} > 12 AND {_DAY} <= 12)"
_HOUR = """
CASE WHEN p[3] = '' THEN 0
     WHEN p[7] = '' THEN try_cast(p[3] AS int)
     WHEN try_cast(p[3] AS int) NOT BETWEEN 1 AND 12 THEN NULL
     ELSE try_cast(p[3] AS int) % 12 + if(lower(p[7]) = 'pm', 12, 0) END"""
_MINUTE = "if(p[4] = '', 0, try_cast(p[4] AS int))"
_SECOND = """
CASE WHEN p[5] = '' THEN cast(0 AS decimal(8,6))
     WHEN p[6] = '' THEN cast(try_cast(p[5] AS int) AS decimal(8,6))
     ELSE try_cast(concat(p[5], '.', substring(p[6], 1, 6)) AS decimal(8,6)) END"""
_SHIFT = """
CASE WHEN p[8] = '' OR p[8] > 'A' THEN 0
     ELSE if(p[8] LIKE '-%', -1, 1) * (try_cast(substring(p[8], 2, 2) AS int) * 60
       + if(length(p[8]) > 3, try_cast(right(p[8], 2) AS int), 0)) END"""
_ASSEMBLE = f"""
p -> CASE WHEN size(p) = 9 THEN
  try_make_timestamp_ntz({_YEAR},
    if({_DAY_FIRST}, {_DAY}, {_MONTH}), if({_DAY_FIRST}, {_MONTH}, {_DAY}),
    {_HOUR}, {_MINUTE}, {_SECOND})
  - make_dt_interval(0, 0, {_SHIFT}, 0) END"""


def parse_timestamp(c: Column) -> Column:
    """CL8: month-first dates, 12/24-hour clocks, month names and offsets to naive UTC.

    A weekday, or the time, may come first. Unparseable text, text without a full date and six
    digits alone give NULL. Day-first dates are understood
    only where the first number cannot be a month.
    """
    text = F.regexp_replace(c.cast("string"), r"^\s+|\s+$", "")
    canonical = F.regexp_replace(text, _WEEKDAY, "")
    canonical = F.regexp_replace(canonical, _TIME_FIRST, "$2 $1")
    for shape, (y, m, d) in _SHAPES:
        fields = _CUT.join(f"${i}" for i in (y, m, d, 4, 5, 6, 7, 8, 9))
        canonical = F.regexp_replace(canonical, shape, fields)
    # The one-element transform binds the split parts, so they are computed once per value.
    parts = F.array(F.split(canonical, _CUT))
    general = F.get(F.call_function("transform", parts, F.expr(_ASSEMBLE)), F.lit(0))
    return F.when(text.rlike(_PLAIN_ISO), text.try_cast("timestamp_ntz")).otherwise(general)


def utc_now() -> Column:
    """The current time as naive UTC, whatever the session time zone."""
    return F.convert_timezone(None, F.lit("UTC"), F.localtimestamp())


def iso_text(c: Column) -> Column:
    """A naive timestamp in ISO form, with a fraction only where there is one."""
    text = c.cast("timestamp_ntz").cast("string")
    fraction = F.when(F.length(text) > 19, F.rpad(F.substring(text, 20, 7), 7, "0")).otherwise("")
    return F.concat(F.substring(text, 1, 10), F.lit("T"), F.substring(text, 12, 8), fraction)
