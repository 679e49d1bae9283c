"""Trailing windows of a cutoff date. All are half-open: start <= ts < end."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

DAYS_PER_YEAR = 365.25
EPOCH = "2000-01-01"


def years_before(cutoff: Column, years: int) -> Column:
    return F.add_months(cutoff, -12 * years)


def january_first(year: Column) -> Column:
    return F.make_date(year, F.lit(1), F.lit(1))


def cutoff_windows(cutoff: Column) -> dict[str, tuple[Column, Column]]:
    """The named windows of the covariates.

    ``1y 5y 10y`` end at the cutoff; ``clim10`` is ten whole calendar years before the
    cutoff year; ``spring`` is March to May of the last spring that ended by the cutoff.
    """
    year = F.year(cutoff)
    spring = F.when(cutoff >= F.make_date(year, F.lit(6), F.lit(1)), year).otherwise(year - 1)
    return {
        "1y": (years_before(cutoff, 1), cutoff),
        "5y": (years_before(cutoff, 5), cutoff),
        "10y": (years_before(cutoff, 10), cutoff),
        "clim10": (january_first(year - 10), january_first(year)),
        "spring": (
            F.make_date(spring, F.lit(3), F.lit(1)),
            F.make_date(spring, F.lit(6), F.lit(1)),
        ),
    }


def in_window(ts: Column, start: Column, end: Column) -> Column:
    """Never true on the cutoff itself, so nothing after the observation leaks in."""
    return (ts >= start) & (ts < end)


def epoch_years(ts: Column) -> Column:
    """Years of 365.25 days since 2000-01-01, with the time of day as a fraction.

    Taken from the calendar fields, so daylight saving of the session's zone has no part in it.
    """
    ts = ts.cast("timestamp_ntz")
    days = F.datediff(ts.cast("date"), F.lit(EPOCH).cast("date"))
    seconds = F.hour(ts) * 3600 + F.minute(ts) * 60 + F.extract(F.lit("SECOND"), ts).cast("double")
    return (days + seconds / 86400) / F.lit(DAYS_PER_YEAR)


def years_since(ts: Column, start: Column) -> Column:
    return epoch_years(ts) - epoch_years(start)


def harmonic_basis(t: Column) -> list[Column]:
    """cos and sin of the yearly and the half-yearly cycle."""
    angle = F.lit(2 * math.pi) * t
    return [F.cos(angle), F.sin(angle), F.cos(2 * angle), F.sin(2 * angle)]
