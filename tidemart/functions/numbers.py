"""Exact half-up ratios for dashboard figures."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def div_half_up(num: Column, den: Column, scale: int) -> Column:
    """``num / den`` of non-negative whole numbers, rounded half up to ``scale`` places, in integers only.

    Null when the divisor is zero.
    """
    unit = 10**scale
    num = num.cast("decimal(20,0)")
    den = F.nullif(den.cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)"))
    units = F.call_function("div", num * F.lit(2 * unit) + den, den * F.lit(2))
    return (units.cast("decimal(20,0)") / F.lit(unit)).cast(f"decimal(20,{scale})")


def _guarded(value: Column, uv: Column, scale: int) -> Column:
    zero = F.lit(0).cast(f"decimal(20,{scale})")
    return F.when(uv != 0, F.coalesce(value, zero)).otherwise(zero)


def uj_rate(uj: Column, sv: Column, uv: Column) -> Column:
    """Bounce rate in percent, two places; 0 without visitors or visits."""
    return _guarded(div_half_up(uj * 100, sv, 2), uv, 2)


def dur_per_sv(dur_ms: Column, sv: Column, uv: Column) -> Column:
    """Seconds per visit: rounded to whole milliseconds first, then to one decimal of a second."""
    return _guarded(div_half_up(div_half_up(dur_ms, sv, 0), F.lit(1000), 1), uv, 1)


def pv_per_sv(pv: Column, sv: Column, uv: Column) -> Column:
    return _guarded(div_half_up(pv, sv, 2), uv, 2)
