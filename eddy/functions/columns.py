"""Column-level helpers (scalar functions). All are built-in Spark
expressions, so they stay inside whole-stage codegen."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .fixed import ALERT_RISING, ALERT_ROSE, ALERT_SENSOR, COGROUP_ITEM_SEP, JOIN_TEXT_SEP

_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_us(ts, ntz: bool = True) -> Column:
    """Microseconds since the epoch, independent of the session time zone for
    ``timestamp_ntz`` input (the wall clock is read as UTC)."""
    ts = _c(ts)
    if ntz:
        # NTZ - NTZ is a day-time interval computed without any time zone
        # (timestamp_diff would go through the session zone and shift local
        # times that fall into a DST gap)
        iv = (ts - F.expr(_EPOCH_NTZ)).cast("interval second")
        return (iv.cast("decimal(24,6)") * F.lit(1_000_000)).cast("bigint")
    return F.unix_micros(ts)


def ntz_from_us(us) -> Column:
    """``timestamp_ntz`` from epoch microseconds (inverse of ``epoch_us``)."""
    return F.timestamp_add("MICROSECOND", _c(us), F.expr(_EPOCH_NTZ))


def ltz_from_us(us) -> Column:
    """``timestamp`` (instant) from epoch microseconds."""
    return F.timestamp_micros(_c(us))


def to_event_time(ts) -> Column:
    """``timestamp_ntz`` wall clock -> ``timestamp`` instant, read as UTC.

    Watermarks need the instant type; this conversion does not depend on the
    session time zone (a plain cast would)."""
    return ltz_from_us(epoch_us(ts))


_UNITS_US = {
    "microsecond": 1, "millisecond": 1000, "second": 1_000_000,
    "minute": 60_000_000, "hour": 3_600_000_000, "day": 86_400_000_000,
    "week": 7 * 86_400_000_000,
}


def duration_us(text: str | int) -> int:
    """'3 hours' / '1 day' / '500 milliseconds' -> microseconds. Ints pass."""
    if isinstance(text, int):
        return text
    total = 0
    for num, unit in re.findall(r"(-?\d+(?:\.\d+)?)\s*([a-zA-Z]+)", text):
        u = unit.lower().rstrip("s")
        if u not in _UNITS_US:
            raise ValueError(f"unknown time unit {unit!r} in {text!r}")
        total += int(float(num) * _UNITS_US[u])
    if total == 0 and not re.search(r"\d", text):
        raise ValueError(f"cannot parse duration {text!r}")
    return total


def strictly_above(value, threshold: float) -> Column:
    """``value > threshold`` with Java semantics for NaN (NaN is never above;
    Spark orders NaN above every number)."""
    v = _c(value)
    return (~F.isnan(v)) & (v > F.lit(threshold))


def abs_diff_at_least(a, b, threshold: float) -> Column:
    """``abs(a - b) >= threshold``; NaN on either side is never an alarm."""
    a, b = _c(a), _c(b)
    return (~F.isnan(a)) & (~F.isnan(b)) & (F.abs(a - b) >= F.lit(threshold))


def concat_pair(left, right, sep: str = JOIN_TEXT_SEP) -> Column:
    """Join-function output: left value, separator, right value."""
    return F.concat_ws(sep, _c(left), _c(right))


def order_struct(*cols) -> Column:
    """A struct usable as a total sort key (ts first, then tie-breaks)."""
    return F.struct(*[_c(c) for c in cols])


def fold_block(header: str, items, key_sep: str = COGROUP_ITEM_SEP) -> Column:
    """Render ``header`` then one ``k=>v`` line per item of an array of
    ``struct(k, v)`` (already ordered), every line ending in a newline."""
    lines = F.transform(_c(items), lambda x: F.concat(
        x["k"].cast("string"), F.lit(key_sep), x["v"].cast("string"),
        F.lit("\n")))
    return F.concat(F.lit(header), F.array_join(lines, ""))


def alert_text(key, interval_s) -> Column:
    """Message of the continuous-rise alarm."""
    return F.concat(F.lit(ALERT_SENSOR), _c(key).cast("string"), F.lit(ALERT_RISING), F.lit(str(interval_s)), F.lit(ALERT_ROSE))


def split_like_java(line, sep: str = ",") -> Column:
    """``String.split(sep)`` semantics: trailing empty fields are dropped; an
    input made only of separators gives an empty array, while the empty string
    gives one empty field."""
    line = _c(line)
    esc = re.escape(sep)
    stripped = F.regexp_replace(line, f"({esc})+$", "")
    return (F.when((stripped == "") & (line != ""), F.array().cast("array<string>"))
            .otherwise(F.split(stripped, esc)))
