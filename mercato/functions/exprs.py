"""Column expressions shared by the operators.

Everything here returns a ``Column`` built from ``pyspark.sql.functions``,
so it stays inside whole-stage codegen; no Python UDF is involved.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
DAY_MICROS = 86_400_000_000  # one day of naive (zone-free) time
AVG_MONTH_MICROS = 2_629_746_000_000  # 365.2425 / 12 days, numpy's average month
EARTH_RADIUS_KM = 6371.0


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def micros_between(start: str | Column, end: str | Column) -> Column:
    """Microseconds from ``start`` to ``end``, independent of the session time zone.

    Subtracting two ``TIMESTAMP_NTZ`` values gives a day-time interval measured
    on the naive clock (every day is 86 400 s); adding it to the epoch and
    reading the microseconds back turns it into a number without passing
    through a zone.  (``timestamp_diff`` would first place naive values in
    the session zone, so a day across a daylight-saving change would count
    23 or 25 hours.)
    """
    return F.unix_micros(F.timestamp_micros(F.lit(0)) + (_col(end) - _col(start)))


def days_between(start: str | Column, end: str | Column) -> Column:
    """Fractional days from ``start`` to ``end`` (86 400 s per day); null if either is null."""
    return micros_between(start, end) / F.lit(float(DAY_MICROS))


def avg_months_between(start: str | Column, end: str | Column) -> Column:
    """Fractional average-length months (30.436875 days) from ``start`` to ``end``."""
    return micros_between(start, end) / F.lit(float(AVG_MONTH_MICROS))


def round_half_even(x: str | Column, decimals: int = 0) -> Column:
    """numpy-style rounding: scale, round half to even on the double, unscale."""
    c = _col(x)
    if decimals == 0:
        return F.rint(c)
    scale = float(10**decimals)
    return F.rint(c * scale) / scale


def clamp_non_positive(x: str | Column) -> Column:
    """``0 if x <= 0 else x`` where a missing ``x`` stays missing."""
    c = _col(x)
    return F.when(c <= 0, F.lit(0.0)).otherwise(c.cast("double"))


def positive_or_zero(x: str | Column) -> Column:
    """``x if x > 0 else 0``: a missing ``x`` becomes 0 (``nan > 0`` is false)."""
    c = _col(x)
    return F.when(c > 0, c.cast("double")).otherwise(F.lit(0.0))


def star_flag(score: str | Column, stars: int) -> Column:
    """1 when the score equals ``stars``, else 0 (also 0 for a missing score)."""
    return F.when(_col(score) == stars, F.lit(1)).otherwise(F.lit(0))


def sum_or_zero(x: str | Column) -> Column:
    """Sum that gives 0.0 over no values or only missing values."""
    return F.coalesce(F.sum(_col(x)).cast("double"), F.lit(0.0))


def haversine_km(lon1: str | Column, lat1: str | Column, lon2: str | Column, lat2: str | Column) -> Column:
    """Great-circle distance in km between (lon1, lat1) and (lon2, lat2), degrees in."""
    rlon1, rlat1, rlon2, rlat2 = (F.radians(_col(c)) for c in (lon1, lat1, lon2, lat2))
    sin_dlat = F.sin((rlat2 - rlat1) / 2.0)
    sin_dlon = F.sin((rlon2 - rlon1) / 2.0)
    a = sin_dlat * sin_dlat + F.cos(rlat1) * F.cos(rlat2) * sin_dlon * sin_dlon
    return F.lit(2.0 * EARTH_RADIUS_KM) * F.asin(F.sqrt(F.least(a, F.lit(1.0))))


def bin_edge(i: Column | int, lo: float, hi: float, bins: int) -> Column:
    """Left edge of bin ``i`` on an equal-width grid, as ``linspace`` computes it."""
    step = (hi - lo) / bins
    i = F.lit(i) if isinstance(i, int) else i
    return F.when(i >= bins, F.lit(float(hi))).otherwise(i.cast("double") * F.lit(step) + F.lit(float(lo)))


def bin_index(x: str | Column, lo: float, hi: float, bins: int) -> Column:
    """Equal-width bin of ``x`` in ``[lo, hi]``: bins are ``[a, b)``, the last ``[a, b]``.

    Null outside the range.  The first guess is corrected against the
    exact edges, so a value sitting on an edge lands where a sorted
    search over the edges would put it.
    """
    c = _col(x).cast("double")
    norm = bins / (hi - lo)
    guess = F.floor((c - F.lit(float(lo))) * F.lit(norm))
    guess = F.when(guess >= bins, F.lit(bins - 1)).otherwise(guess)
    lowered = F.when(c < bin_edge(guess, lo, hi, bins), guess - 1).otherwise(guess)
    raised = F.when(
        (c >= bin_edge(lowered + 1, lo, hi, bins)) & (lowered != bins - 1), lowered + 1
    ).otherwise(lowered)
    in_range = (c >= F.lit(float(lo))) & (c <= F.lit(float(hi)))
    return F.when(in_range, raised.cast("int"))

