"""Calendar expressions. Weekday 0 is Monday, as `weekday` counts (not `dayofweek`)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Calendar feature names and default Fourier periods with their harmonics.
CYCLIC_NAMES = [
    "Day_of_week_sin",
    "Day_of_week_cos",
    "Month_sin",
    "Month_cos",
    "Day_of_month_sin",
    "Day_of_month_cos",
]
ONEHOT_NAMES = [f"Day_of_week_{i}" for i in range(1, 7)]
FOURIER_PERIODS = {365.25: 3, 7.0: 2, 3.5: 1, 2.3: 1}


def date_parts(day: Column) -> dict[str, Column]:
    return {
        "Day_of_week": F.weekday(day),
        "Month": F.month(day),
        "Day_of_month": F.dayofmonth(day),
    }


def _angle(position: Column, cycle: float) -> Column:
    return F.pi() * 2 * position / F.lit(float(cycle))


def cyclic(day: Column) -> dict[str, Column]:
    """Sine and cosine of the position in week, year and month; months and days count from 0."""
    positions = [
        _angle(F.weekday(day), 7),
        _angle(F.month(day) - 1, 12),
        _angle(F.dayofmonth(day) - 1, 31),
    ]
    waves = [wave(angle) for angle in positions for wave in (F.sin, F.cos)]
    return dict(zip(CYCLIC_NAMES, waves))


def onehot_weekday(day: Column) -> dict[str, Column]:
    """Tuesday to Sunday indicators; Monday is the base level whatever days occur."""
    return {f"Day_of_week_{i}": (F.weekday(day) == i).cast("int") for i in range(1, 7)}


def weekend(day: Column) -> Column:
    return (F.weekday(day) >= 5).cast("int")


def calendar_features(day: Column) -> dict[str, Column]:
    """All 13 calendar features of a day: cyclic, weekend and weekday indicators."""
    return {**cyclic(day), "Weekend": weekend(day), **onehot_weekday(day)}


def period_label(period: float) -> str:
    if period >= 365:
        return "annual"
    if 6 <= period <= 8:
        return "weekly"
    if 3 <= period < 4:
        return "half_week"
    return "short_cycle"


def fourier(
    days_since_anchor: Column,
    periods: Sequence[float] | None = None,
    harmonics: Mapping[float, int] | None = None,
) -> dict[str, Column]:
    """Sine and cosine waves per period and harmonic (one harmonic unless stated)."""
    if periods is None:
        periods = list(FOURIER_PERIODS)
    if harmonics is None:
        harmonics = FOURIER_PERIODS
    waves: dict[str, Column] = {}
    for period in periods:
        for k in range(1, harmonics.get(period, 1) + 1):
            angle = F.pi() * 2 * k * days_since_anchor / F.lit(float(period))
            waves[f"{period_label(period)}_sin_{k}"] = F.sin(angle)
            waves[f"{period_label(period)}_cos_{k}"] = F.cos(angle)
    return waves
