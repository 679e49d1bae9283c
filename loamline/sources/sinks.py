"""Writers. Spark's commit protocol publishes an output only when its job is complete."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamline.schema import require_safe_names
from loamline.sources.snapshots import row_hash

MAP_BANDS = [
    f"{target}_{part}"
    for target in ("soc_pct", "bulk_density")
    for part in ("prediction", "lower_90", "upper_90", "interval_width")
] + ["valid_data_mask"]


def write_table(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """Table with dates as ``yyyy-MM-dd`` and safe column names."""
    require_safe_names(df)
    dates = [name for name, dtype in df.dtypes if dtype == "date"]
    out = df.withColumns({c: F.date_format(c, "yyyy-MM-dd") for c in dates}) if fmt == "csv" else df
    writer = out.write.mode("overwrite").format(fmt)
    (writer.option("header", True) if fmt == "csv" else writer).save(path)


def write_covariates(df: DataFrame, path: str) -> None:
    """Point covariates by cutoff date."""
    _write_parts(df, path, ["covariate_cutoff_date"])


def _write_parts(df: DataFrame, path: str, parts: Sequence[str]) -> None:
    # The rebalance gives each folder few files; adaptive execution splits a busy one.
    (
        df.hint("rebalance", *parts).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(path)
    )


def output_qc(maps: DataFrame, bands: Sequence[str] = tuple(MAP_BANDS)) -> DataFrame:
    """Per tile and depth: pixels, valid pixels and an order-free fingerprint of the values, a
    sum, so that a row that occurs twice changes it."""
    return maps.groupBy("tile", "depth_cm").agg(
        F.count("*").alias("n_pixels"),
        F.sum(F.col("valid_data_mask").eqNullSafe(1.0).cast("int")).cast("bigint").alias("n_valid"),
        F.sum(row_hash(maps, ["row", "col", *bands])).cast("decimal(38,0)").cast("string").alias("fingerprint"),
    )
