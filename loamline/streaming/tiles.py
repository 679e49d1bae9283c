"""Incremental map runs: every new tile file is scored once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from loamline.operators.model import Bundle
from loamline.plans.maps import run_pending
from loamline.schema import DEPTHS_CM
from loamline.session import stored
from loamline.sources.snapshots import is_published, sources

#: Column of a stream that names the file a row comes from.
FILE = "source_file"


def tile_stream(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Tile files as they arrive, with the file of each row."""
    rows = spark.readStream.schema(schema).parquet(path)
    return rows.withColumn(FILE, F.col("_metadata.file_path"))


def score_batch(
    batch: DataFrame, name: str, bundles: Sequence[Bundle], out: str,
    depths: Sequence[float] = DEPTHS_CM, lrr: DataFrame | None = None,
) -> bool:
    """Publishes a batch's pixels under its name, once; False if there was nothing to do.

    The ledger knows published batches and files, so a replayed batch, or a file that comes
    again under another batch, is left out without a look at the maps.
    """
    spark = batch.sparkSession
    if is_published(spark, out, name):
        return False
    files = batch.groupBy(F.col(FILE).alias("file")).agg(F.count("*").alias("n"))
    files = stored(files.join(sources(spark, out).select("file"), "file", "left_anti"))
    if files.isEmpty():
        return False
    fresh = batch.join(files.select(F.col("file").alias(FILE)), FILE, "left_semi").drop(FILE)
    return run_pending(fresh, bundles, out, depths, lrr, batch=name, files=files) is not None


def score_new_tiles(
    stream: DataFrame, bundles: Sequence[Bundle], out: str, checkpoint: str,
    depths: Sequence[float] = DEPTHS_CM, lrr: DataFrame | None = None,
) -> StreamingQuery:
    """Processes what has arrived and stops.

    A batch is visible with one commit or not at all; replayed after a failure, it is published
    if its commit is missing and skipped if it is there. A later file of a tile adds its pixels.
    """
    def score(batch: DataFrame, number: int) -> None:
        score_batch(batch, f"{checkpoint}#{number}", bundles, out, depths, lrr)

    return (
        stream.writeStream.foreachBatch(score)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
