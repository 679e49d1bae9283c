"""Exact global ranks without a single-partition window.

The rows are range-partitioned by the sort key and sorted inside each partition; the slot
numbers are fixed by a reliable checkpoint, and one count per partition (as many rows as
there are partitions) turns them into global positions.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loamline.functions.clean import pad_id
from loamline.session import stored

#: Rows that the tasks' first rows are merged to in one place.
TOP_ROWS = 10_000
_SLOT_BITS = 33  # monotonically_increasing_id keeps the partition above these bits


def _ranged(df: DataFrame, order: Sequence[Column | str]) -> DataFrame:
    """Rows in global order, tagged with partition and slot, fixed by a checkpoint."""
    tagged = stored(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("__slot", F.monotonically_increasing_id())
    )
    return tagged.withColumn("__part", F.shiftright("__slot", _SLOT_BITS))


def _with_offsets(tagged: DataFrame, weight: Column) -> DataFrame:
    # One row per partition: the window and the broadcast are bounded by the partition count.
    before = W.orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        tagged.groupBy("__part").agg(F.sum(weight).alias("__rows"))
        .select("__part", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__offset"))
    )
    return tagged.join(F.broadcast(offsets), "__part")


def global_position(df: DataFrame, order: Sequence[Column | str], name: str = "position") -> DataFrame:
    """Adds the 0-based position of each row in the global order.

    ``order`` must end in a unique key, both for a stable result and so that ties spread
    over partitions.
    """
    placed = _with_offsets(_ranged(df, order), F.lit(1))
    local = F.col("__slot").bitwiseAND(F.lit((1 << _SLOT_BITS) - 1))
    return placed.withColumn(name, (F.col("__offset") + local).cast("bigint")).drop(
        "__slot", "__part", "__offset"
    )


def running_total(
    df: DataFrame, order: Sequence[Column | str], weight: str, name: str = "running"
) -> DataFrame:
    """Adds the inclusive running sum of ``weight`` over the global order."""
    inside = W.partitionBy("__part").orderBy("__slot").rowsBetween(W.unboundedPreceding, 0)
    placed = _with_offsets(_ranged(df, order), F.col(weight))
    return placed.withColumn(name, F.col("__offset") + F.sum(weight).over(inside)).drop(
        "__slot", "__part", "__offset"
    )


def assign_point_ids(observations: DataFrame, prefix: str) -> DataFrame:
    """Distinct (lat, lon, cutoff date) with ids numbered from 1 in date, lat, lon order."""
    keys = ["covariate_cutoff_date", "lat", "lon"]
    places = observations.select("lat", "lon", "covariate_cutoff_date").distinct()
    ranked = global_position(places, keys, "__n")
    return ranked.select(
        pad_id(prefix, F.col("__n") + 1).alias("point_id"), "lat", "lon", "covariate_cutoff_date"
    )


def systematic_sample(
    df: DataFrame, by: str, tiebreak: Sequence[str], wanted: int = 600
) -> DataFrame:
    """Every ``max(1, n // wanted)``-th row of the frame sorted by ``by``.

    Only the keys are ranked and stored; the few sampled keys (under twice ``wanted``)
    then fetch their rows. ``by`` and ``tiebreak`` together must tell rows apart.
    """
    keys = list(dict.fromkeys([by, *tiebreak]))
    ranked = global_position(df.select(*keys), keys, "__n")
    step = max(1, ranked.count() // wanted)
    sampled = ranked.where(F.col("__n") % step == 0).select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)])
    return df.join(F.broadcast(sampled), same, "left_semi")


def first_rows(df: DataFrame, order: Sequence[str], n: int = 20) -> DataFrame:
    """The first ``n`` rows in the order of the given columns.

    Up to ``TOP_ROWS`` rows every task keeps its own first rows and these are merged; beyond,
    the keys alone are ranked and rows up to the n-th key stay, so that no task gathers them.
    ``order`` must then tell rows apart.
    """
    if n <= TOP_ROWS:
        return df.orderBy(*order).limit(n)
    keys = list(order)
    last = global_position(df.select(*keys), keys, "__n").where(F.col("__n") == n - 1).select(
        F.struct(*keys).alias("__last")
    ).first()
    if last is None:
        return df
    limit = F.struct(*[F.lit(last["__last"][k]).cast(df.schema[k].dataType).alias(k) for k in keys])
    return df.where(F.struct(*keys) <= limit)


def group_folds(df: DataFrame, key: str, k: int = 5) -> DataFrame:
    """Balanced folds 1..k in which a group never spans two folds.

    Groups are ordered by size (largest first) and dealt out in a snake: 1..k, k..1, ...
    Only the table of groups is ranked. Rows without a group are dropped.
    """
    sizes = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("__size"))
    ranked = global_position(sizes, [F.desc("__size"), F.asc(key)], "__n")
    turn = F.col("__n") % (2 * k)
    fold = F.when(turn < k, turn + 1).otherwise(2 * k - turn).cast("int")
    return df.join(ranked.select(key, fold.alias("fold")), key)
