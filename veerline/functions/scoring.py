from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import DEFAULT, Settings


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def zscore(value: Column | str, mean: Column | str, std: Column | str, signed: bool = False) -> Column:
    """Distance from the mean in standard deviations; 0 without spread, baseline or value.

    A NULL value (no bytes reported all day) counts 0: otherwise ``least`` in ``capped``
    would skip the NULL and grant the full term.
    """
    distance = _col(value) - _col(mean)
    if not signed:
        distance = F.abs(distance)
    return F.coalesce(F.when(_col(std) > 0, distance / _col(std)), F.lit(0.0))


def capped(z: Column | str, weight: float, cap: float = DEFAULT.zscore_cap) -> Column:
    return F.least(F.coalesce(_col(z), F.lit(0.0)) / F.lit(float(cap)), F.lit(1.0)) * F.lit(float(weight))


def sum_terms(terms: Iterable[tuple[str, float]], cap: float) -> Column:
    """Capped terms added from left to right; the order decides ties at a threshold."""
    total = None
    for name, weight in terms:
        term = capped(name, weight, cap)
        total = term if total is None else total + term
    return total


def after_hours(settings: Settings = DEFAULT) -> Column:
    """1.0 where the day starts or ends more than the margin outside the user's usual hours."""
    margin = settings.after_hours_margin
    early = F.col("first_activity_hour") < F.col("baseline_typical_start_hour") - margin
    late = F.col("last_activity_hour") > F.col("baseline_typical_end_hour") + margin
    return F.when(early | late, 1.0).otherwise(0.0)


def ladder(score: Column | str, settings: Settings = DEFAULT) -> Column:
    """Risk level of a score."""
    score = _col(score)
    return (
        F.when(score >= settings.critical, "CRITICAL")
        .when(score >= settings.high, "HIGH")
        .when(score >= settings.medium, "MEDIUM")
        .otherwise("LOW")
    )


def outlier_band(z: Column | str, settings: Settings = DEFAULT) -> Column:
    """Strength of an outlier; NULL where the threshold is not passed."""
    z = F.abs(_col(z))
    return (
        F.when(z > settings.zscore_very_strong, "very_strong")
        .when(z > settings.zscore_strong, "strong")
        .when(z > settings.zscore_threshold, "potential")
    )


def baseline_ratio(value: Column | str, mean: Column | str) -> Column:
    """How many times the baseline a value is; NULL where the baseline is 0 or missing."""
    return F.when(_col(mean) != 0, _col(value) / _col(mean))
