"""Readers of tables, text manifests and partitioned series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loamline.schema import require_columns


def read_table(
    spark: SparkSession, path: str, columns: Sequence[str] | None = None,
    schema: str | None = None, fmt: str = "parquet",
) -> DataFrame:
    """Named columns of a Parquet, ORC, JSON or CSV table; a missing name fails here.

    CSV is read with a header row and needs a schema, so nothing is inferred from the data.
    """
    reader = spark.read.format(fmt)
    if fmt == "csv":
        if schema is None:
            raise ValueError("a CSV table needs a schema")
        reader = reader.option("header", True).option("mode", "PERMISSIVE")
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.load(path)
    return df if columns is None else require_columns(df, columns, path).select(*columns)


def read_sheets(
    spark: SparkSession, paths: dict[str, str], columns: dict[str, Sequence[str]],
    schemas: dict[str, str] | None = None, fmt: str = "parquet",
) -> dict[str, DataFrame]:
    """Sheets of a workbook, each exported to its own table."""
    schemas = schemas or {}
    return {
        name: read_table(spark, path, columns.get(name), schemas.get(name), fmt)
        for name, path in paths.items()
    }


def read_tables(spark: SparkSession, paths: dict[str, str], fmt: str = "parquet") -> dict[str, DataFrame]:
    """A relational source as frames that are also temporary views of the same names."""
    frames = {name: read_table(spark, path, fmt=fmt) for name, path in paths.items()}
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name)
    return frames


def read_jdbc(spark: SparkSession, url: str, tables: Sequence[str], **options: str) -> dict[str, DataFrame]:
    """Tables of a relational database, read only, through the JDBC source."""
    return {
        name: spark.read.format("jdbc").options(url=url, dbtable=name, **options).load()
        for name in tables
    }


def catalog_profile(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows and columns per table."""
    parts = [
        frame.agg(
            F.lit(name).alias("table_name"), F.count("*").alias("n_rows"),
            F.lit(len(frame.columns)).cast("bigint").alias("n_columns"),
        )
        for name, frame in tables.items()
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Entries of a text manifest, without blank and comment lines, in byte order."""
    return sorted_manifest(manifest_lines(spark.read.text(path), "value"))


def manifest_lines(df: DataFrame, column: str) -> DataFrame:
    """Trimmed lines that are neither blank nor start with ``#``."""
    line = F.trim(F.regexp_replace(F.col(column), r"^\s+|\s+$", ""))
    return df.select(line.alias("entry")).where(
        (F.col("entry") != "") & ~F.col("entry").startswith("#")
    )


def sorted_manifest(df: DataFrame) -> DataFrame:
    return df.orderBy("entry")


def scan_series(
    df: DataFrame, start: str, end: str, bands: Sequence[str], cells: DataFrame | None = None
) -> DataFrame:
    """Images of a collection with ``start <= ts < end``; the bands asked for; the cells
    asked for, if a frame of ``cell_id`` is given.

    Where the table is partitioned by ``year``, an explicit year range prunes partitions.
    """
    rows = df.where(
        (F.col("ts") >= F.lit(start).cast("timestamp")) & (F.col("ts") < F.lit(end).cast("timestamp"))
    )
    if "year" in df.columns:
        rows = rows.where(F.col("year").between(int(start[:4]), int(end[:4])))
    rows = rows.select("cell_id", "ts", *bands)
    if cells is not None:
        rows = rows.join(cells.select("cell_id").distinct(), "cell_id", "left_semi")
    return rows


def scan_static(df: DataFrame, value: str, rename: str, mul: float = 1.0) -> DataFrame:
    """One band of a static raster under its covariate name."""
    column = F.col(value) if mul == 1.0 else F.col(value) * F.lit(mul)
    return df.select("cell_id", column.alias(rename))


def scan_polygons(df: DataFrame, where: Column) -> DataFrame:
    return df.where(where)


def scan_tiles(df: DataFrame, bands: Sequence[str], tiles: DataFrame | None = None) -> DataFrame:
    """Pixels ``(tile, row, col, bands...)``; of the named tiles only, if given. On a table
    partitioned by ``tile`` the semi-join prunes partitions at run time."""
    rows = require_columns(df, ["tile", "row", "col", *bands], "tiles").select(
        "tile", "row", "col", *bands
    )
    return rows if tiles is None else rows.join(tiles.select("tile").distinct(), "tile", "left_semi")
