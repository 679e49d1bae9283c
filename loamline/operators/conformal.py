"""Split-conformal multipliers and calibrated intervals."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamline.functions.intervals import conformity, interval
from loamline.operators.quantiles import order_statistics


def quantile_level(n: int, coverage: float) -> float:
    return min(1.0, math.ceil((n + 1) * coverage) / n)


def conformal_rank(n: int, coverage: float = 0.9, rule: str = "reference") -> int:
    """0-based rank of the calibrating score among ``n``.

    "reference" takes the next element at or above position ``level * (n - 1)``, which is
    one rank above the "textbook" split-conformal element for most n.
    """
    if rule == "textbook":
        return min(n, math.ceil((n + 1) * coverage)) - 1
    if rule != "reference":
        raise ValueError(f"unknown rule {rule!r}")
    return min(n - 1, math.ceil(quantile_level(n, coverage) * (n - 1)))


def conformal_multiplier(
    df: DataFrame, coverage: float = 0.9, rule: str = "reference", score: Column | None = None
) -> dict[str, float]:
    """Multiplier of the error scale: an exact order statistic of ``|error| / scale``.

    Reads observed, predicted and scale; rows with a missing part or a zero scale do not
    count. Returns multiplier, n, rank and level.
    """
    if score is None:
        score = conformity(F.col("observed"), F.col("predicted"), F.col("scale"))
    def rank(n: int) -> int:
        return conformal_rank(n, coverage, rule)

    n, found = order_statistics(df, {"score": score}, lambda n: [rank(n)])["score"]
    if not n:
        raise ValueError("no calibration scores")
    return {
        "multiplier": found[rank(n)], "n": n, "rank": rank(n),
        "level": quantile_level(n, coverage),
    }


def add_intervals(df: DataFrame, multiplier: float) -> DataFrame:
    """Adds the predicted error, half width and bounds of the 90 % interval."""
    lower, upper, width = interval(F.col("predicted"), F.col("scale"), multiplier)
    return df.withColumns(
        {
            "predicted_absolute_error": F.col("scale"),
            "half_width_90": F.lit(multiplier) * F.col("scale"),
            "lower_90": lower, "upper_90": upper, "interval_width": width,
        }
    )


def calibrate(
    train: DataFrame, external: DataFrame, coverage: float = 0.9, rule: str = "reference"
) -> tuple[DataFrame, DataFrame, dict[str, float]]:
    """Multiplier from the training scores, intervals on both sets."""
    fitted = conformal_multiplier(train, coverage, rule)
    m = fitted["multiplier"]
    return add_intervals(train, m), add_intervals(external, m), fitted


def mapping_multiplier(
    train: DataFrame, external: DataFrame, coverage: float = 0.9
) -> dict[str, float]:
    """Multiplier calibrated on the external set for mapping, and its ratio to the
    training multiplier. It widens mapped intervals only."""
    own = conformal_multiplier(train, coverage)["multiplier"]
    mapped = conformal_multiplier(external, coverage)["multiplier"]
    return {
        "calibration_multiplier": own, "mapping_multiplier": mapped,
        "mapping_ratio": mapped / own,
    }
