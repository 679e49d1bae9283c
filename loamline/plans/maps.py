"""Scoring covariate tiles to prediction maps, skipping what is already written."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamline.operators.features import contract, resolved
from loamline.operators.model import Bundle
from loamline.operators.stack import at_depths, valid_mask
from loamline.schema import DEPTHS_CM, NODATA, resolve_bands
from loamline.session import bounded_broadcast, stored
from loamline.sources.sinks import MAP_BANDS, output_qc
from loamline.sources.snapshots import PAIR, pixel_sums, publish, published_pairs, read_snapshot

PIXEL = ["tile", "row", "col"]


def score_tiles(
    tiles: DataFrame, bundles: Sequence[Bundle], depths: Sequence[float] = DEPTHS_CM,
    lrr: DataFrame | None = None, wanted: DataFrame | None = None, done: DataFrame | None = None,
) -> DataFrame:
    """Map pixels ``(tile, row, col, depth_cm, bands..., valid_data_mask)``.

    A pixel is scored only if all bands of all models are valid; the others come out as
    nodata at every depth. All models and depths share a scan of the valid pixels; the others
    take a second one. ``wanted`` restricts the output to (tile, depth_cm) pairs, ``done``
    leaves out (tile, row, col, depth_cm).
    """
    required = list(dict.fromkeys(f for b in bundles for f in b.features))
    features = contract(required)
    bands = resolve_bands(tiles.columns, required)
    pixels = tiles.select(*PIXEL, *[F.col(band).alias(f) for f, band in bands.items()])
    marked = valid_mask(pixels, list(bands))
    key = [*PIXEL, "depth_cm"]
    if wanted is not None:
        # One row per tile; on a table partitioned by tile the join prunes its partitions.
        todo = wanted.groupBy("tile").agg(F.collect_set("depth_cm").alias("__depths"))
        marked = marked.join(bounded_broadcast(todo), "tile")

    def exploded(df: DataFrame) -> DataFrame:
        if wanted is None:
            deep = at_depths(df, depths, "depth_cm")
        else:
            deep = df.withColumn("depth_cm", F.explode("__depths"))
        return deep if done is None else deep.join(done, key, "left_anti")

    # Models cost far more than a shuffle of their inputs, and a file of one row group would
    # else be scored by one task. The same contract as in training; the bands already have
    # their features' names.
    named = exploded(marked.where("valid").repartition(*PIXEL)).withColumn("z_mid", F.col("depth_cm"))
    valid = resolved(named, features, key, lrr)
    scored, carried = valid, key
    for bundle in bundles:
        keep = list(dict.fromkeys([*carried, *required]))
        out = [f"{bundle.target.name}_{p}" for p in ("prediction", "lower_90", "upper_90", "interval_width")]
        scored = bundle.score(scored, keep)
        carried = [*carried, *out]
    values = carried[len(key):]
    made = scored.select(
        *key, *[F.col(c).cast("float").alias(c) for c in values],
        F.lit(1.0).cast("float").alias("valid_data_mask"),
    )
    gaps = exploded(marked.where(~F.col("valid"))).select(
        *key, *[F.lit(NODATA).cast("float").alias(c) for c in [*values, "valid_data_mask"]]
    )
    return made.unionByName(gaps)


def run_pending(
    tiles: DataFrame, bundles: Sequence[Bundle], path: str,
    depths: Sequence[float] = DEPTHS_CM, lrr: DataFrame | None = None, overwrite: bool = False,
    batch: str | None = None, files: DataFrame | None = None,
) -> DataFrame | None:
    """Scores what is not published yet, publishes it in one commit and returns the QC rows of
    the (tile, depth) pairs it went through; None if all of them were complete.

    A pair is complete if number and sum of hashes of its pixels, as the manifest has them,
    equal those of ``tiles``. In a pair that is published in part only the missing pixels are
    scored and added, so a tile may come in several files and a repeated run changes nothing;
    published pixels are read for such pairs alone. ``overwrite`` scores and replaces every
    pair. ``batch`` and ``files`` go to the ledger.
    """
    spark = tiles.sparkSession
    tiles = tiles.withColumn("tile", F.col("tile").cast("string"))
    wanted = at_depths(pixel_sums(tiles, ["tile"]), depths, "depth_cm")
    if overwrite:
        todo = wanted.withColumn("begun", F.lit(False))
    else:
        had = published_pairs(spark, path).withColumnsRenamed({"n": "had", "mark": "had_mark"})
        same = (F.col("n") == F.col("had")) & (F.col("mark") == F.col("had_mark"))
        todo = wanted.join(had, PAIR, "left").withColumn("begun", F.col("had").isNotNull()).where(
            ~F.coalesce(same, F.lit(False))
        )
    todo = stored(todo.select(*PAIR, "begun"))
    if todo.isEmpty():
        return None
    begun, known = todo.where("begun"), None
    if not begun.isEmpty():
        schema = wanted.join(tiles.select(*PIXEL), "tile").select(*PIXEL, "depth_cm").schema
        known = read_snapshot(spark, path, schema).join(begun, PAIR, "left_semi")
    scored = score_tiles(tiles, bundles, depths, lrr, todo, known)
    version = publish(scored, path, overwrite, batch, files)
    maps = read_snapshot(spark, path, scored.schema, version)
    return output_qc(maps.join(todo, PAIR, "left_semi"), [b for b in MAP_BANDS if b in maps.columns])
