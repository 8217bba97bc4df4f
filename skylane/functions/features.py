"""Scalar feature expressions (X1-X8, P11, F7): plain Column arithmetic, codegen'd.

Missing-value rules follow the pandas originals: comparisons with a missing value
are false, so flags become 0 and the period falls through to "night"; season and
distance bins stay missing.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Time-of-day periods (minutes since midnight, half-open).
PERIODS = [(0, 360, "midnight"), (360, 720, "morning"), (720, 1080, "afternoon")]
PERIOD_OTHER = "night"
# Rush-hour windows (minutes, half-open).
RUSH_WINDOWS = [(360, 540), (1020, 1200)]
# Weekend days with 1 = Monday .. 7 = Sunday.
WEEKEND_DAYS = [6, 7]
# Season limits on day of year.
SEASON_WINTER_BEFORE, SEASON_SPRING_BEFORE, SEASON_SUMMER_BEFORE, SEASON_AUTUMN_BEFORE = 80, 172, 266, 355
# Default distance bin edges (intervals open on the left) and labels.
DISTANCE_EDGES = [0, 500, 1000, 2000, math.inf]
DISTANCE_LABELS = ["short", "medium", "long", "very_long"]
DELAY_THRESHOLD = 15


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def cyclic(c: str | Column, period: float) -> tuple[Column, Column]:
    """(sin, cos) of 2*pi*c/period."""
    angle = F.lit(2 * math.pi) * _c(c) / F.lit(float(period))
    return F.sin(angle), F.cos(angle)


def hhmm_to_minutes(c: str | Column) -> Column:
    """HHMM -> minutes after midnight with floor semantics (-5 -> -60 + 95 = 35)."""
    x = _c(c)
    return F.floor(x / F.lit(100)) * 60 + F.pmod(x, F.lit(100))


def time_period(c: str | Column) -> Column:
    """Period label; anything outside [0, 1080), NULL included, is "night"."""
    x = _c(c)
    expr = None
    for lo, hi, name in PERIODS:
        cond = (x >= lo) & (x < hi)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.otherwise(F.lit(PERIOD_OTHER))


def rush_hour(c: str | Column) -> Column:
    """1 inside a rush window, else 0 (NULL -> 0)."""
    x = _c(c)
    cond = F.lit(False)
    for lo, hi in RUSH_WINDOWS:
        cond = cond | ((x >= lo) & (x < hi))
    return F.coalesce(cond, F.lit(False)).cast("int")


def weekend(c: str | Column) -> Column:
    """1 on Saturday/Sunday, else 0 (NULL -> 0)."""
    return F.coalesce(_c(c).isin(*WEEKEND_DAYS), F.lit(False)).cast("int")


def season(c: str | Column) -> Column:
    """Northern-hemisphere season from day of year; NULL stays NULL."""
    x = _c(c)
    return (
        F.when((x < SEASON_WINTER_BEFORE) | (x >= SEASON_AUTUMN_BEFORE), F.lit("winter"))
        .when(x < SEASON_SPRING_BEFORE, F.lit("spring"))
        .when(x < SEASON_SUMMER_BEFORE, F.lit("summer"))
        .when(x < SEASON_AUTUMN_BEFORE, F.lit("autumn"))
    )


def distance_bins(c: str | Column, edges: Sequence[float] = DISTANCE_EDGES,
                  labels: Sequence[str] = DISTANCE_LABELS) -> Column:
    """Label of the interval (a, b] holding ``c``; outside or NULL -> NULL."""
    if len(labels) != len(edges) - 1:
        raise ValueError("need one label per interval")
    x = _c(c)
    expr = None
    for a, b, name in zip(edges[:-1], edges[1:], labels):
        cond = x > F.lit(float(a))
        if not math.isinf(b):
            cond = cond & (x <= F.lit(float(b)))
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr


def day_of_year(y: str | Column, m: str | Column, d: str | Column, lenient: bool = False) -> Column:
    """Day of year of (y, m, d). Invalid dates raise (ANSI) unless ``lenient``."""
    if lenient:
        ts = F.try_make_timestamp(_c(y), _c(m), _c(d), F.lit(0), F.lit(0), F.lit(0))
        return F.dayofyear(ts)
    return F.dayofyear(F.make_date(_c(y), _c(m), _c(d)))


def binarise(c: str | Column, threshold: float = DELAY_THRESHOLD) -> Column:
    """1 when ``c >= threshold``, else 0 (NULL and NaN -> 0)."""
    return F.coalesce(F.nanvl(_c(c).cast("double"), F.lit(None).cast("double")) >= F.lit(threshold), F.lit(False)).cast("int")


def at_threshold(p: str | Column, threshold: float = 0.5) -> Column:
    """inclusive threshold on a score."""
    return (_c(p) >= F.lit(threshold)).cast("int")


def hash_hex(seed: int | str, key: str | Column) -> Column:
    """Portable pseudo-random key: md5 of ``'<seed>|' || key`` (same text in DuckDB)."""
    return F.md5(F.concat(F.lit(f"{seed}|"), _c(key).cast("string")))


def hash_int(hexcol: Column, digits: int = 15) -> Column:
    """Leading ``digits`` hex digits as a non-negative bigint (15 digits: 2^60 values)."""
    return F.conv(F.substring(hexcol, 1, digits), 16, 10).cast("bigint")


def hash_unit(seed: int | str, key: str | Column) -> Column:
    """Uniform double in [0, 1) from the first 32 bits of the md5 key."""
    return hash_int(hash_hex(seed, key), 8).cast("double") / F.lit(4294967296.0)
