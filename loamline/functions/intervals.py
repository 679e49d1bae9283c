"""Log-scale targets, error scales and interval bounds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loamline.functions.clean import at_least


def log1p_target(value: Column) -> Column:
    return F.log1p(value)


def expm1_clip(prediction: Column) -> Column:
    """Back from the log scale, never below zero."""
    return at_least(F.expm1(prediction), 0.0)


def floor_scale(prediction: Column, floor: float) -> Column:
    """Predicted absolute error back from the log scale, held at the target's floor."""
    return at_least(F.expm1(prediction), floor)


def absolute_error(observed: Column, predicted: Column) -> Column:
    return F.abs(observed - predicted)


def conformity(observed: Column, predicted: Column, scale: Column) -> Column:
    return F.try_divide(absolute_error(observed, predicted), scale)


def interval(predicted: Column, scale: Column, multiplier: float | Column) -> tuple[Column, Column, Column]:
    """Lower bound (not below zero), upper bound and width."""
    half = F.lit(multiplier) * scale
    lower = at_least(predicted - half, 0.0)
    upper = predicted + half
    return lower, upper, upper - lower
