"""Coercions, predicates and labels used while cleaning observations.

Null rule of the whole library: a missing value is SQL NULL (never NaN), it passes through
every expression, and predicates meant for filters return false on it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NUMBER_TEXT = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
# Seconds from 1970 whose date a nanosecond clock can hold; anything else is not a date.
EPOCH_SECONDS = 9_223_372_036


def at_least(value: Column, floor: float | Column) -> Column:
    """``max(value, floor)`` that keeps NULL; plain ``greatest`` would return the floor."""
    return F.when(value.isNotNull(), F.greatest(value, F.lit(floor).cast("double")))


def no_nan(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def to_number(text: Column) -> Column:
    """Text to double; anything that is not a decimal number becomes NULL."""
    text = text.cast("string")
    return F.when(text.rlike(NUMBER_TEXT), text.try_cast("double"))


def to_day(text: Column) -> Column:
    """Date or timestamp text to DATE; unparsable text becomes NULL."""
    return F.try_to_timestamp(F.trim(text.cast("string"))).cast("date")


def mixed_date(text: Column) -> Column:
    """Calendar text, or else unix seconds written as text, to DATE (of UTC)."""
    text = F.trim(text.cast("string"))
    seconds = to_number(text)
    in_range = F.abs(seconds) <= EPOCH_SECONDS
    return F.when(seconds.isNull(), to_day(text)).otherwise(
        F.date_from_unix_date(F.floor(F.when(in_range, seconds) / 86400).cast("int"))
    )


def is_true(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def valid_coord(lat: Column, lon: Column) -> Column:
    """Inside the geographic bounds (inclusive) and not the (0, 0) placeholder."""
    return is_true(
        lat.between(-90, 90) & lon.between(-180, 180) & ~((lat == 0) & (lon == 0))
    )


def non_negative(value: Column) -> Column:
    return is_true(value >= 0)


def measure_range(value: Column, low: float, below: float) -> Column:
    """``low <= value < below``; false on NULL."""
    return is_true((value >= low) & (value < below))


def carbonate_correct(carbon: Column, caco3: Column, k: float = 0.12) -> Column:
    """Total carbon less the carbonate share where carbonate was found, clipped at zero."""
    corrected = F.when(is_true(caco3 > 0), carbon - F.lit(k) * caco3).otherwise(carbon)
    return at_least(corrected, 0.0)


def date_between(day: Column, first: str, last: str) -> Column:
    return is_true(day.between(F.lit(first).cast("date"), F.lit(last).cast("date")))


def valid_flag(flag: Column) -> Column:
    return is_true(flag.cast("boolean"))


def first_rule(rules: list[tuple[Column, str]], default: Column) -> Column:
    """Label of the first rule that holds; a NULL condition does not hold."""
    chain = F
    for condition, label in rules:
        chain = chain.when(condition, F.lit(label))
    return chain.otherwise(default)


def coalesce_with_source(choices: list[tuple[Column, str]], missing: str | None) -> tuple[Column, Column]:
    """First present value and the label of the column it came from."""
    value = F.coalesce(*[c for c, _ in choices])
    label = first_rule([(c.isNotNull(), name) for c, name in choices], F.lit(missing))
    return value, label


def depth_mid(top: Column, bottom: Column) -> Column:
    return (top + bottom) / 2


SHALLOW = "0–30 cm"
DEEP = ">30 cm"


def depth_group(z_mid: Column, limit: float = 30.0) -> Column:
    """Shallow below the limit; the limit itself and a missing depth count as deep."""
    return F.when(z_mid < limit, F.lit(SHALLOW)).otherwise(F.lit(DEEP))


def depth_bin(z_mid: Column, size: int = 10) -> Column:
    return F.floor(z_mid / size).cast("bigint")


def numeric_id(text: Column) -> Column:
    """Digits of a mixed identifier as a number; -999 where there are none."""
    digits = F.regexp_replace(F.coalesce(text, F.lit("")), "[^0-9]", "")
    return F.when(F.length(digits) > 0, digits.try_cast("bigint")).otherwise(
        F.lit(-999).cast("bigint")
    )


def date_tag(day: Column) -> Column:
    return F.replace(F.date_format(day, "yyyy-MM-dd"), F.lit("-"), F.lit("_"))


def from_millis(millis: Column) -> Column:
    return F.timestamp_millis(millis)


def pad_id(prefix: str, number: Column, width: int = 6) -> Column:
    """``prefix_000042``; numbers wider than the padding are kept whole."""
    digits = number.cast("string")
    return F.concat(
        F.lit(prefix + "_"),
        F.when(F.length(digits) >= width, digits).otherwise(F.lpad(digits, width, "0")),
    )
