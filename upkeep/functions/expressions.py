"""Scalar column expressions (all JVM-side, codegen-friendly, ANSI-safe)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from upkeep import schema as S

__all__ = [
    "whole_days_between", "season", "right_closed_bin", "cost_category", "size_category",
    "height_category", "risk_category", "timeframe_days", "confidence", "parse_bool",
    "safe_ratio", "clamp01", "day_of_week_monday0", "age_years", "round4",
]

_MICROS_PER_DAY = 86_400_000_000


def whole_days_between(later: Column, earlier: Column) -> Column:
    """Elapsed whole 24-hour days (floor), not calendar-date difference.

    23:00 -> 01:00 next day is 0 here while ``datediff`` says 1.
    """
    return F.floor((F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(_MICROS_PER_DAY)).cast("long")


def day_of_week_monday0(ts: Column) -> Column:
    """Monday = 0 ... Sunday = 6."""
    return F.weekday(ts)


def season(month: Column) -> Column:
    expr = None
    for name, months in S.SEASONS.items():
        cond = month.isin(*months)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.when(month.isNotNull(), F.lit("autumn"))


def right_closed_bin(x: Column, bins, lower: float = 0.0) -> Column:
    """Bins (lower, e1], (e1, e2], ...; values <= lower or null give null."""
    expr = None
    for edge, label in bins:
        cond = x <= F.lit(edge)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return F.when(x > F.lit(lower), expr)


def cost_category(cost: Column) -> Column:
    return right_closed_bin(cost, S.COST_BINS)


def size_category(area: Column) -> Column:
    return right_closed_bin(area, S.AREA_BINS)


def height_category(floors: Column) -> Column:
    return right_closed_bin(floors.cast("double"), S.FLOOR_BINS)


def risk_category(p: Column, low: float = S.LOW_RISK_THRESHOLD,
                  high: float = S.HIGH_RISK_THRESHOLD) -> Column:
    return (F.when(p < F.lit(low), F.lit("low"))
            .when(p < F.lit(high), F.lit("medium"))
            .when(p.isNotNull(), F.lit("high")))


def timeframe_days(p: Column, steps=S.TIMEFRAME_STEPS) -> Column:
    expr = None
    for cut, days in steps:
        cond = p > F.lit(cut)
        expr = F.when(cond, F.lit(days)) if expr is None else expr.when(cond, F.lit(days))
    return expr.cast("long")


def confidence(p: Column) -> Column:
    return F.least(F.lit(S.CONFIDENCE_CAP),
                   F.greatest(F.lit(S.CONFIDENCE_FLOOR), p * F.lit(S.CONFIDENCE_SLOPE)))


def parse_bool(raw: Column) -> Column:
    """Explicit boolean parsing: true/false words and 1/0; anything else is null."""
    s = F.lower(F.trim(raw.cast("string")))
    return (F.when(s.isin("true", "t", "yes", "y", "1", "1.0"), F.lit(True))
            .when(s.isin("false", "f", "no", "n", "0", "0.0"), F.lit(False)))


def safe_ratio(num: Column, den: Column) -> Column:
    """num / den, null when den is 0 or either side is null (ANSI-safe)."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def clamp01(x: Column) -> Column:
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), x))


def age_years(ts: Column, reference_date: str = S.AGE_REFERENCE_DATE) -> Column:
    ref = F.to_timestamp(F.lit(reference_date))
    return whole_days_between(ts, ref) / F.lit(S.DAYS_PER_YEAR)


def round4(x: Column) -> Column:
    return F.round(x, 4)


def round_half_up(col: Column, digits: int = 0) -> Column:
    """``F.round`` of a double, without its decimal where the doubles alone tell the result.

    The product with the power of ten is off by less than 1e-5 up to 1e10, so whole numbers
    below and above it are certain unless it lies close to their middle; the quotient of two exact numbers is the nearest double.
    """
    power = F.lit(float(10 ** digits))
    scaled = F.abs(col) * power
    whole = F.floor(scaled + F.lit(0.5)).cast("double")
    certain = (scaled < F.lit(1e10)) & (F.abs(scaled - whole) < F.lit(0.4999))
    return F.when(certain, F.when(col < 0, F.lit(0.0) - whole / power).otherwise(whole / power)).otherwise(F.round(col, digits))
