"""Column expressions shared by the operators. None depends on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SECONDS_PER_DAY = 86_400
MICROS_PER_DAY = SECONDS_PER_DAY * 1_000_000

# A double such as 0.2000...01 stands for 20 % and must not climb a step.
STEP_TOLERANCE = 1e-9


def check_mode(mode: str) -> str:
    if mode not in ("spec", "as_written"):
        raise ValueError(f"mode must be 'spec' or 'as_written', not {mode!r}")
    return mode


def real(column: Column | str) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("double")


def ratio(part: Column | str, whole: Column | str) -> Column:
    """Quotient in double precision, NULL where the divisor is zero."""
    return F.try_divide(real(part), real(whole))


def seconds_between(start: Column, end: Column) -> Column:
    return (end - start).cast("interval second").cast("decimal(18,6)")


def micros_between(start: Column, end: Column) -> Column:
    return (seconds_between(start, end) * F.lit(1_000_000)).cast("long")


def days_between(start: Column, end: Column) -> Column:
    """Elapsed days with their fraction."""
    return real(seconds_between(start, end)) / F.lit(float(SECONDS_PER_DAY))


def whole_days_between(start: Column, end: Column) -> Column:
    """Elapsed days cut toward zero: full 24-hour spans, not midnights passed."""
    return F.extract(F.lit("DAY"), end - start)


def month_number(moment: Column | str) -> Column:
    """Number of the calendar month, counted from year 0."""
    moment = F.col(moment) if isinstance(moment, str) else moment
    return F.year(moment) * 12 + F.month(moment) - 1


def hour_bucket(moment: Column | str) -> Column:
    """Number of the clock hour since 1970; purchases of one bucket lie under a day apart."""
    moment = F.col(moment) if isinstance(moment, str) else moment
    return F.unix_date(moment.cast("date")) * 24 + F.hour(moment)


def purchase_interval(first: Column, last: Column, purchases: Column) -> Column:
    """Average days from one purchase of a group to the next (the group frequency)."""
    return (days_between(first, last) + F.lit(1.0)) / real(purchases)


def round_to_step(share: Column, rounding: str = "up", step: float = 5.0) -> Column:
    """A share (0.12) as a percentage on a fixed grid (15.0 up, 10.0 down)."""
    steps = share * F.lit(100.0 / step)
    if rounding == "up":
        steps = F.ceil(steps - F.lit(STEP_TOLERANCE))
    elif rounding == "down":
        steps = F.floor(steps + F.lit(STEP_TOLERANCE))
    else:
        raise ValueError(f"rounding must be 'up' or 'down', not {rounding!r}")
    return real(steps) * F.lit(float(step))
