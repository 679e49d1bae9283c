"""Prediction maps as snapshots: staged files, then one commit that makes them visible.

A publication writes its pixels into a folder of its own, then the rows of a manifest that name,
for every (tile, depth) it touches, all folders the pair now consists of, and last a commit of
one row in one file. Readers take the committed versions, the latest manifest rows of each pair
and only the folders those name, so a pair is seen whole in its old or in its new state. What a
failed publication has written is never named by a commit. Nothing published is changed or
removed, so a plan on an older version keeps its rows.

The manifest also keeps number and sum of hashes of the pixels of every pair, and the ledger the
batch and the source files of a publication: what is done is known without reading any pixel.

    data/run=<run>/depth_cm=<d>/tile=<t>/   pixels
    manifest/by=<run>/                      (tile, depth_cm, run, n, mark)
    ledger/by=<run>/                        (batch, file, n)
    commits/                                (version, run, batch), one file a version

One writer at a time publishes to a map, as one streaming query or one job does.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

PAIR = ["tile", "depth_cm"]
_COMMITS = "version long, run string, batch string"
_MANIFEST = "tile string, depth_cm double, run string, n long, mark decimal(38,0), by string"
_LEDGER = "batch string, file string, n long, by string"


def _read(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """The table at a path; none there is an empty one."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def commits(spark: SparkSession, path: str) -> DataFrame:
    """(version, run, batch) of every publication that is visible."""
    return _read(spark, f"{path}/commits", _COMMITS)


def latest(spark: SparkSession, path: str) -> int:
    return commits(spark, path).agg(F.max("version")).first()[0] or 0


def is_published(spark: SparkSession, path: str, batch: str) -> bool:
    return not commits(spark, path).where(F.col("batch") == batch).isEmpty()


def _committed(rows: DataFrame, path: str, version: int | None) -> DataFrame:
    """Rows of the committed folders, with their version: one row a publication is joined."""
    known = commits(rows.sparkSession, path).select(F.col("run").alias("by"), "version")
    if version is not None:
        known = known.where(F.col("version") <= version)
    return rows.join(known, "by").drop("by")


def manifest(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """(tile, depth_cm, run, n, mark) of the folders that make up each pair at a version."""
    rows = _committed(_read(spark, f"{path}/manifest", _MANIFEST), path, version)
    last = F.max("version").over(W.partitionBy(*PAIR))
    return rows.withColumn("last", last).where("version = last").drop("version", "last")


def sources(spark: SparkSession, path: str) -> DataFrame:
    """(batch, file, n) of all files whose pixels are published."""
    return _committed(_read(spark, f"{path}/ledger", _LEDGER), path, None).drop("version")


def read_snapshot(spark: SparkSession, path: str, schema: StructType | str, version: int | None = None) -> DataFrame:
    """Pixels of a version (the latest if none is given), with the columns of ``schema``."""
    schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    data = _read(spark, f"{path}/data", StructType(schema.fields).add("run", StringType()))
    live = manifest(spark, path, version).select("run", *PAIR)
    return data.join(live, ["run", *PAIR], "left_semi").select(*schema.names)


def pixel_sums(pixels: DataFrame, by: Sequence[str]) -> DataFrame:
    """Number of pixels and sum of the hashes of their places."""
    mark = F.sum(F.xxhash64(F.col("row").cast("long"), F.col("col").cast("long")).cast("decimal(38,0)"))
    return pixels.groupBy(*by).agg(F.count("*").alias("n"), mark.alias("mark"))


def published_pairs(spark: SparkSession, path: str) -> DataFrame:
    """(tile, depth_cm, n, mark) of each published pair, from the manifest alone."""
    return manifest(spark, path).groupBy(*PAIR).agg(
        F.sum("n").alias("n"), F.sum("mark").cast("decimal(38,0)").alias("mark")
    )


def publish(
    pixels: DataFrame, path: str, replace: bool = False, batch: str | None = None, files: DataFrame | None = None
) -> int:
    """Makes ``pixels(tile, row, col, depth_cm, ...)`` visible at once; returns the version.

    They are added to their pairs, or take the place of the pairs with ``replace``; other pairs
    stay. ``files(file, n)`` are the sources the ledger notes under ``batch``.
    """
    spark = pixels.sparkSession
    run = uuid.uuid4().hex
    staged = f"{path}/data/run={run}"
    # The rebalance gives each folder few files; adaptive execution splits a busy one.
    pixels.hint("rebalance", "depth_cm", "tile").write.partitionBy("depth_cm", "tile").parquet(staged)
    own = pixel_sums(spark.read.schema(pixels.schema).parquet(staged), PAIR)
    rows = own.select(
        F.col("tile").cast("string"), F.col("depth_cm").cast("double"), F.lit(run).alias("run"), "n",
        F.col("mark").cast("decimal(38,0)"),
    )
    if not replace:
        # Pairs are extended: the folders they had are named again.
        rows = rows.unionByName(manifest(spark, path).join(rows.select(*PAIR), PAIR, "left_semi"))
    rows.write.parquet(f"{path}/manifest/by={run}")
    if files is not None:
        files.select(F.lit(batch).alias("batch"), "file", "n").write.parquet(f"{path}/ledger/by={run}")
    return _commit(spark, path, run, batch)


def _commit(spark: SparkSession, path: str, run: str, batch: str | None) -> int:
    version = latest(spark, path) + 1
    one = spark.createDataFrame([(version, run, batch)], _COMMITS)
    one.coalesce(1).write.mode("append").parquet(f"{path}/commits")
    return version


# --- digests ---------------------------------------------------------------------------

def _exact(column: str, kind: str) -> Column:
    """A value as text that any engine writes alike: numbers with ten decimals."""
    value = F.col(column)
    if kind in ("float", "double"):
        text = value.cast("double").try_cast("decimal(38,10)").cast("string")
        return F.coalesce(text, value.cast("string"), F.lit("null"))
    return F.coalesce(value.cast("string"), F.lit("null"))


def row_hash(df: DataFrame, columns: Sequence[str]) -> Column:
    """The first 60 bits of the SHA-256 of a row's values, as a number that can be summed."""
    kinds = dict(df.dtypes)
    text = F.concat_ws(",", *[_exact(c, kinds[c]) for c in columns])
    return F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast("decimal(38,0)")


def _joined(key: str) -> Column:
    """Digests of a group, in the order of their keys, as one digest."""
    ordered = F.array_sort(F.collect_list(F.struct(F.col(key), F.col("digest"))))
    return F.sha2(F.array_join(F.transform(ordered, lambda x: x["digest"]), ""), 256)


def merkle(maps: DataFrame, bands: Sequence[str]) -> DataFrame:
    """(level, depth_cm, branch, tile, n_pixels, digest): a tree of digests over the maps.

    A ``tile`` leaf covers one (tile, depth) by the sum of its rows' hashes, so the order of the
    rows is of no account, but a changed, lost or repeated row is. Leaves of a depth are
    gathered by the first three hexadecimal digits of the tile's hash to a ``branch``, at most
    4,096 branches to a ``depth``, and the depths to the ``map``. So no group grows with the map,
    and two maps are compared from the top down.
    """
    leaves = maps.groupBy("depth_cm", "tile").agg(
        F.count("*").alias("n_pixels"), F.sum(row_hash(maps, ["row", "col", *bands])).alias("total")
    )
    name = F.concat_ws("|", F.coalesce("tile", F.lit("null")), _exact("depth_cm", dict(maps.dtypes)["depth_cm"]), "n_pixels", "total")
    leaves = leaves.select(
        "depth_cm", F.substring(F.sha2(F.coalesce("tile", F.lit("null")), 256), 1, 3).alias("branch"), "tile", "n_pixels",
        F.sha2(name, 256).alias("digest"),
    )
    branches = leaves.groupBy("depth_cm", "branch").agg(F.sum("n_pixels").alias("n_pixels"), _joined("tile").alias("digest"))
    depths = branches.groupBy("depth_cm").agg(F.sum("n_pixels").alias("n_pixels"), _joined("branch").alias("digest"))
    # One row a depth.
    whole = depths.agg(F.sum("n_pixels").alias("n_pixels"), _joined("depth_cm").alias("digest")).where("n_pixels > 0")
    levels = {"tile": leaves, "branch": branches, "depth": depths, "map": whole}
    found = None
    for level, rows in levels.items():
        rows = rows.withColumn("level", F.lit(level))
        found = rows if found is None else found.unionByName(rows, allowMissingColumns=True)
    return found.select("level", "depth_cm", "branch", "tile", "n_pixels", "digest")


def differing_tiles(one: DataFrame, other: DataFrame) -> DataFrame:
    """(depth_cm, tile) in which two trees differ; only differing branches are compared."""
    def differing(level: str, keys: list[str], within: DataFrame | None = None) -> DataFrame:
        sides = []
        for tree, name in ((one, "a"), (other, "b")):
            rows = tree.where(F.col("level") == level)
            if within is not None:
                rows = rows.join(within, ["depth_cm", "branch"], "left_semi")
            sides.append(rows.select(*keys, F.col("digest").alias(name)))
        return sides[0].join(sides[1], keys, "full").where(~F.col("a").eqNullSafe(F.col("b"))).select(*keys)

    branches = differing("branch", ["depth_cm", "branch"])
    return differing("tile", ["depth_cm", "branch", "tile"], branches).select("depth_cm", "tile")
