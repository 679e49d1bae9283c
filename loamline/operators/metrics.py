"""Regression and interval metrics, spatial support change, histograms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamline.functions.clean import depth_bin, depth_group, no_nan
from loamline.functions.spatial import pixel_id, web_mercator
from loamline.operators.quantiles import group_quantiles, quantiles

MIN_GROUP = 30
PIXEL_KEYS = ["pixel_x_250m", "pixel_y_250m", "depth_bin_10cm"]


def _finite(value: Column) -> Column:
    value = no_nan(value.cast("double"))
    return F.when(~value.isin(float("inf"), float("-inf")), value)


def _measured(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Metrics and the number of all rows per group, in one aggregation."""
    y, p = _finite(F.col("observed")), _finite(F.col("predicted"))
    both = y.isNotNull() & p.isNotNull()
    pairs = df.select(*by, F.when(both, y).alias("y"), F.when(both, p).alias("p"))
    error = F.col("p") - F.col("y")
    n, squares, spread = F.count("y"), F.sum(error * error), F.count("y") * F.var_pop("y")
    # A constant y leaves no spread to explain: 1 for a perfect fit, else 0.
    r2 = (
        F.when(n < 2, F.lit(None).cast("double"))
        .when(spread > 0, 1 - F.try_divide(squares, spread))
        .otherwise(F.when(squares == 0, 1.0).otherwise(0.0))
    )
    return pairs.groupBy(*by).agg(
        n.alias("n"), r2.alias("r2"),
        F.sqrt(F.avg(error * error)).alias("rmse"), F.avg(F.abs(error)).alias("mae"),
        F.avg(error).alias("bias"),
        F.avg("y").alias("mean_observed"), F.avg("p").alias("mean_predicted"),
        F.count("*").alias("rows"),
    )


def regression_metrics(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """n, R2, RMSE, MAE, bias and means of (observed, predicted), finite pairs only.

    ``R2 = 1 - sum(e²) / (n var(y))``; NULL for fewer than two pairs.
    """
    return _measured(df, by).drop("rows")


def subgroup_metrics(df: DataFrame, by: str, minimum: int = MIN_GROUP) -> DataFrame:
    """Metrics of the groups with at least ``minimum`` rows; the NULL group is kept."""
    return _measured(df, [by]).where(F.col("rows") >= minimum).drop("rows")


def pixel_depth(df: DataFrame, means: Sequence[str] = ("observed", "predicted")) -> DataFrame:
    """Means per 250 m cell and 10 cm depth bin, and the number of horizons in it."""
    x, y = web_mercator(F.col("lon"), F.col("lat"))
    keyed = df.withColumns(
        dict(zip(PIXEL_KEYS, [pixel_id(x), pixel_id(y), depth_bin(F.col("z_mid"))]))
    )
    return keyed.groupBy(*PIXEL_KEYS).agg(
        *[F.avg(c).alias(c) for c in means], F.count("*").alias("n_horizons")
    )


def _complete(df: DataFrame, by: Sequence[str]) -> DataFrame:
    names = ["observed", "predicted", "lower_90", "upper_90"]
    rows = df.select(*by, *[no_nan(F.col(c).cast("double")).alias(c) for c in names])
    return rows.dropna(subset=names).withColumn("width", F.col("upper_90") - F.col("lower_90"))


def _interval_aggregates() -> list[Column]:
    covered = F.col("observed").between(F.col("lower_90"), F.col("upper_90"))
    return [
        F.count("*").alias("n"), F.avg(covered.cast("double")).alias("coverage_90"),
        F.avg("width").alias("mean_interval_width"),
        F.avg("lower_90").alias("mean_lower"), F.avg("upper_90").alias("mean_upper"),
    ]


def interval_metrics(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Coverage (bounds inclusive), mean and median width and mean bounds of complete rows.

    Groups are named by non-NULL keys.
    """
    rows = _complete(df, by)
    if not by:
        median = quantiles(rows, {"width": F.col("width")}, (0.5,))["width"][0]
        return rows.agg(
            *_interval_aggregates(), F.lit(median).cast("double").alias("median_interval_width")
        )
    by = list(by)
    medians = group_quantiles(rows, by, ["width"], (0.5,)).select(
        *by, F.col("width")[0].alias("median_interval_width")
    )
    return rows.groupBy(*by).agg(*_interval_aggregates()).join(medians, by)


def uncertainty_by_depth(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Interval metrics of the shallow and the deep samples."""
    grouped = df.withColumn("depth_group", depth_group(F.col("z_mid")))
    return interval_metrics(grouped, [*by, "depth_group"])


def histogram(df: DataFrame, column: str, bins: int = 50, clip: float | None = 0.99) -> DataFrame:
    """Counts in equal bins between minimum and (clipped) maximum: (bin, low, high, n).

    Empty bins have n = 0. If all values are equal there is one bin; without values, none.
    """
    value = F.col(column).cast("double")
    rows = df.where(value.isNotNull()).select(value.alias("v"))
    if clip is not None:
        cap = quantiles(rows, {"v": F.col("v")}, (clip,))["v"][0]
        rows = rows.select(F.least(F.col("v"), F.lit(cap)).alias("v"))
    ends = rows.agg(F.min("v").alias("low"), F.max("v").alias("high")).first()
    low, high = ends["low"], ends["high"]
    if low is None:
        return rows.selectExpr(
            "cast(0 as bigint) AS bin", "v AS low", "v AS high", "cast(0 as bigint) AS n"
        ).limit(0)
    width = (high - low) / bins or 1.0
    slot = F.least(F.floor((F.col("v") - F.lit(low)) / F.lit(width)), F.lit(bins - 1)).cast("bigint")
    counts = rows.groupBy(slot.alias("bin")).agg(F.count("*").alias("n"))
    every = df.sparkSession.range(bins if high > low else 1).select(F.col("id").alias("bin"))
    return every.join(counts, "bin", "left").select(
        "bin", (F.lit(low) + F.col("bin") * width).alias("low"),
        (F.lit(low) + (F.col("bin") + 1) * width).alias("high"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def bin2d(df: DataFrame, x: str, y: str, grid: int = 45) -> DataFrame:
    """Counts on a ``grid`` x ``grid`` raster over the ranges of x and y, empty bins absent."""
    rows = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    ends = rows.agg(
        F.min(x).alias("x0"), F.max(x).alias("x1"), F.min(y).alias("y0"), F.max(y).alias("y1")
    ).first()

    def slot(name: str, low: float | None, high: float | None) -> Column:
        if low is None or high == low:
            return F.lit(0).cast("bigint")
        return F.least(
            F.floor((F.col(name) - F.lit(low)) * grid / F.lit(high - low)), F.lit(grid - 1)
        ).cast("bigint")

    return rows.groupBy(
        slot(x, ends["x0"], ends["x1"]).alias("x_bin"), slot(y, ends["y0"], ends["y1"]).alias("y_bin")
    ).agg(F.count("*").alias("n"))
