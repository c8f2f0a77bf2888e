"""Aggregate expressions for forecast errors. Each combines map-side, so hot groups cost nothing extra."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def absolute_error(actual: str, predicted: str) -> Column:
    return F.abs(F.col(actual) - F.col(predicted))


def mae(actual: str, predicted: str) -> Column:
    return F.avg(absolute_error(actual, predicted))


def rmse(actual: str, predicted: str) -> Column:
    return F.sqrt(F.avg(F.pow(F.col(actual) - F.col(predicted), 2)))


def mape(actual: str, predicted: str, epsilon: float = 1.0) -> Column:
    """Percentage error; epsilon is added to the signed actual value."""
    difference = F.col(actual) - F.col(predicted)
    return 100 * F.avg(F.abs(F.try_divide(difference, F.col(actual) + F.lit(float(epsilon)))))


def coverage(actual: str, lower: str, upper: str) -> Column:
    return F.avg(F.col(actual).between(F.col(lower), F.col(upper)).cast("double"))


def interval_width(lower: str, upper: str) -> Column:
    return F.avg(F.col(upper) - F.col(lower))


def clamp_bounds(point: str, lower: str, upper: str) -> dict[str, Column]:
    """Bounds that cross the point prediction are moved onto it."""
    return {
        lower: F.least(F.col(lower), F.col(point)),
        upper: F.greatest(F.col(upper), F.col(point)),
    }
