"""Assembling wide covariate rows, and their nodata conventions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamline.schema import NODATA


def stack(base: DataFrame, parts: Sequence[DataFrame], on: Sequence[str]) -> DataFrame:
    """Left-joins one-row-per-key parts onto the base; all share the keys, so the joins
    reuse one partitioning."""
    result = base
    for part in parts:
        result = result.join(part, list(on), "left")
    return result


def concat_tagged(frames: dict[str, DataFrame], tag: str = "dataset") -> DataFrame:
    """Vertical concatenation with the source's name as a column."""
    tagged = [frame.withColumn(tag, F.lit(name)) for name, frame in frames.items()]
    result = tagged[0]
    for frame in tagged[1:]:
        result = result.unionByName(frame)
    return result


def ensure_bands(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Adds the bands that are absent, as NULL."""
    return df.withColumns(
        {n: F.lit(None).cast("double") for n in names if n not in df.columns}
    )


def tag(df: DataFrame, **constants) -> DataFrame:
    return df.withColumns({name: F.lit(value) for name, value in constants.items()})


def fill_nodata(df: DataFrame, columns: Sequence[str], nodata: float = NODATA) -> DataFrame:
    """NULL to the nodata number, so that no point is dropped downstream."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(nodata)) for c in columns})


def valid_mask(
    df: DataFrame, bands: Sequence[str], band_nodata: dict[str, float] | None = None
) -> DataFrame:
    """Adds ``valid``: every band is present, finite and not a nodata number."""
    valid = F.lit(True)
    for band in bands:
        value = F.col(band).cast("double")
        good = (
            value.isNotNull() & ~F.isnan(value)
            & ~value.isin(float("inf"), float("-inf"), NODATA)
        )
        own = (band_nodata or {}).get(band)
        if own is not None:
            good = good & (value != own)
        valid = valid & F.coalesce(good, F.lit(False))
    return df.withColumn("valid", valid)


def batch_manifest(points: dict[str, DataFrame]) -> DataFrame:
    """Points per dataset and cutoff date; points without a date do not count."""
    tagged = concat_tagged(
        {name: df.select("covariate_cutoff_date") for name, df in points.items()}
    )
    return (
        tagged.where(F.col("covariate_cutoff_date").isNotNull())
        .groupBy("dataset", "covariate_cutoff_date")
        .agg(F.count("*").alias("n_points"))
    )


def load_points(df: DataFrame, key: str = "point_id", cutoff: str | None = None) -> DataFrame:
    """Points from text coordinates, one row per id; all cutoff dates unless one is named.

    Of rows that repeat an id the smallest (lat, lon, date) is kept.
    """
    rows = df.select(
        key,
        F.col("lat").cast("string").try_cast("double").alias("lat"),
        F.col("lon").cast("string").try_cast("double").alias("lon"),
        F.col("covariate_cutoff_date").cast("date").alias("covariate_cutoff_date"),
    )
    if cutoff is not None:
        rows = rows.where(F.col("covariate_cutoff_date") == F.lit(cutoff).cast("date"))
    lead = F.min(F.struct("lat", "lon", "covariate_cutoff_date")).alias("r")
    return rows.groupBy(key).agg(lead).select(key, "r.*")


def pending(wanted: DataFrame, done: DataFrame, on: Sequence[str]) -> DataFrame:
    """Wanted outputs that are not written yet."""
    return wanted.join(done.select(*on).distinct(), list(on), "left_anti")


def at_depths(df: DataFrame, depths: Sequence[float], column: str = "z_mid") -> DataFrame:
    """One row per pixel and depth; the depths are a literal list, so nothing is joined."""
    return df.withColumn(column, F.explode(F.array(*[F.lit(float(d)) for d in depths])))
