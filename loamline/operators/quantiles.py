"""Exact order statistics and linearly interpolated quantiles at any size.

* Over a whole frame: a bracket around the wanted rank is narrowed with mergeable sketches
  and verified with exact counts. No sort and no shuffle of the data; only scalars reach
  the driver.
* Per group: the built-in exact percentile for groups of ordinary size. A group with more
  than ``HOT_ROWS`` rows is ranked by range partitions instead, so it never sits in one task.
* Over all parts but one of a frame, for every part (the folds of a cross-fit): counts by part and
  cell, for all columns in one pass; cells that hold wanted ranks are cut again until each is one value.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamline.operators.rank import running_total
from loamline.session import bounded_broadcast, stored

HOT_ROWS = 200_000
_GRID = 1000  # sketch read-outs per pass
_ACCURACY = 10_000  # rank error of the sketch is at most rows / accuracy
_ROUNDS = 20  # passes of narrowing; a few settle any bracket that shrinks
_FETCH = 5_000  # distinct values a final bracket may hold when it is read out
_CELLS = 256  # parts that a range of values is cut into in one pass
_SAMPLE = 20_000  # rows that the first cuts are taken from

# Queries also run where only the driver has the package on its path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _clean(value: Column) -> Column:
    value = value.cast("double")
    return F.when(~F.isnan(value), value)


@dataclass
class _Search:
    """One value column, and the brackets of the ranks still looked for in it."""

    value: Column
    count: int = 0
    grid: list = field(default_factory=list)
    open: dict = field(default_factory=dict)  # (low, high) -> ranks
    found: dict = field(default_factory=dict)

    def look(self, low: float, high: float, rank: int) -> None:
        self.open.setdefault((low, high), []).append(rank)


_STEPS = f"array({', '.join(f'{i / _GRID}D' for i in range(_GRID + 1))})"


def _sketch(value: Column) -> Column:
    return F.percentile_approx(value, F.expr(_STEPS), _ACCURACY)


def _around(grid: list, rank: int, rows: int) -> tuple[float, float]:
    """Bracket a few grid steps wide, wider than the sketch's error."""
    at = math.floor(rank / max(rows - 1, 1) * _GRID)
    return grid[max(at - 2, 0)], grid[min(at + 3, _GRID)]


def _inside(search: _Search, bracket: tuple[float, float]) -> Column:
    return (search.value > bracket[0]) & (search.value < bracket[1])


def _narrow(df: DataFrame, searches: list[_Search]) -> None:
    """One pass of exact counts around each open bracket. Ranks that fall on a bound are
    found; short insides are read out, long ones are sketched and narrowed."""
    jobs = [(search, bracket) for search in searches for bracket in search.open]
    aggs = []
    for i, (search, (low, high)) in enumerate(jobs):
        v = search.value
        aggs += [
            F.count_if(v < low).alias(f"below{i}"), F.count_if(v == low).alias(f"low{i}"),
            F.count_if(_inside(search, (low, high))).alias(f"in{i}"),
            F.count_if(v == high).alias(f"high{i}"),
        ]
    row = df.agg(*aggs).first()
    short, long = [], []
    for i, (search, bracket) in enumerate(jobs):
        start, inside = row[f"below{i}"] + row[f"low{i}"], row[f"in{i}"]
        rests = []
        for rank in search.open.pop(bracket):
            if rank < row[f"below{i}"] or rank >= start + inside + row[f"high{i}"]:
                # The sketch missed: start again from the whole range.
                search.look(search.grid[0], search.grid[-1], rank)
            elif rank < start:
                search.found[rank] = bracket[0]
            elif rank >= start + inside:
                search.found[rank] = bracket[1]
            else:
                rests.append((rank, rank - start))
        if rests:
            (short if inside <= _FETCH else long).append((search, bracket, inside, rests))
    if short:
        for (search, _, _, rests), values in zip(short, _read_out(df, short)):
            search.found.update({rank: values[rest] for rank, rest in rests})
    if long:
        sketches = df.agg(
            *[_sketch(F.when(_inside(s, b), s.value)).alias(f"g{i}") for i, (s, b, _, _) in enumerate(long)]
        ).first()
        for i, (search, _, inside, rests) in enumerate(long):
            for rank, rest in rests:
                search.look(*_around(sketches[f"g{i}"], rest, inside), rank)


def _ranked(df: DataFrame, search: _Search) -> None:
    """What brackets did not settle in ``_ROUNDS`` passes: ranked by range partitions of the
    distinct values."""
    ranks = [rank for found in search.open.values() for rank in found]
    if not ranks:
        return
    weighted = df.select(search.value.alias("v")).where("v IS NOT NULL").groupBy("v").agg(F.count("*").alias("n"))
    placed = running_total(weighted, ["v"], "n", "stop").withColumn("rank", F.explode(F.array(*[F.lit(r) for r in ranks])))
    here = placed.where((F.col("rank") < F.col("stop")) & (F.col("rank") >= F.col("stop") - F.col("n")))
    search.found.update({r["rank"]: r["v"] for r in here.collect()})  # a row a wanted rank
    search.open.clear()


def _read_out(df: DataFrame, short: list) -> list[list[float]]:
    """Sorted values inside short brackets: at most ``_FETCH`` numbers each."""
    tagged = F.array(
        *[
            F.when(_inside(search, bracket), F.struct(F.lit(i).alias("i"), search.value.alias("v")))
            for i, (search, bracket, _, _) in enumerate(short)
        ]
    )
    values: list[list[float]] = [[] for _ in short]
    for r in df.select(F.explode(F.array_compact(tagged)).alias("r")).select("r.*").collect():
        values[r["i"]].append(r["v"])
    return [sorted(v) for v in values]


def order_statistics(
    df: DataFrame, columns: dict[str, Column], ranks
) -> dict[str, tuple[int, dict[int, float]]]:
    """Exact elements of several columns at 0-based ranks of their sorted non-NULL values.

    ``ranks(n)`` gives the ranks wanted from a column with ``n`` values. Result per column:
    its ``n`` and rank -> element. The frame is scanned a few times, so an expensive plan
    should be stored or written before.
    """
    searches = {name: _Search(_clean(value)) for name, value in columns.items()}
    first = df.agg(
        *[F.count(s.value).alias(f"n_{k}") for k, s in searches.items()],
        *[_sketch(s.value).alias(f"g_{k}") for k, s in searches.items()],
    ).first()
    for name, search in searches.items():
        search.count, search.grid = first[f"n_{name}"], first[f"g_{name}"] or []
        if search.count:
            for rank in sorted(set(ranks(search.count))):
                search.look(*_around(search.grid, rank, search.count), rank)
    for _ in range(_ROUNDS):
        still = [s for s in searches.values() if s.open]
        if not still:
            break
        _narrow(df, still)
    for search in searches.values():
        _ranked(df, search)
    return {name: (s.count, s.found) for name, s in searches.items()}


def _interpolated(count: int, found: dict[int, float], prob: float) -> float | None:
    if not count:
        return None
    at = prob * (count - 1)
    low, high = found[math.floor(at)], found[math.ceil(at)]
    return low + (high - low) * (at - math.floor(at))


def quantiles(
    df: DataFrame, columns: dict[str, Column], probs: Sequence[float]
) -> dict[str, list[float | None]]:
    """Linearly interpolated quantiles of whole columns (scalars on the driver)."""
    def ranks(n: int) -> list[int]:
        return [f(p * (n - 1)) for p in probs for f in (math.floor, math.ceil)]

    stats = order_statistics(df, columns, ranks)
    return {name: [_interpolated(n, found, p) for p in probs] for name, (n, found) in stats.items()}


# --- all parts but one -----------------------------------------------------------------

def _steps(values: np.ndarray) -> np.ndarray:
    """Numbers as integers in the same order (zero has one sign), so that any range can be halved
    64 times at most."""
    bits = (values + 0.0).view("i8")
    return np.where(bits < 0, np.int64(-2 ** 63) - bits, bits)


def _values(steps: np.ndarray) -> np.ndarray:
    return np.where(steps < 0, np.int64(-2 ** 63) - steps, steps).view("f8")


_COUNTS = "at int, part int, task int, counts binary, low binary, high binary"


def _counted(cuts: list[np.ndarray], batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows by column, part and cell, and the least and greatest value of a cell. A cut is a cell of
    its own, between those of the values below and above."""
    from pyspark import TaskContext

    found: dict[tuple[int, int], list[np.ndarray]] = {}
    for batch in batches:
        parts = batch.column(len(cuts)).to_numpy()
        for at, edges in enumerate(cuts):
            whole = batch.column(at).to_numpy(zero_copy_only=False).astype(float)
            there = ~np.isnan(whole)
            values, of = whole[there] + 0.0, parts[there]
            cell = np.searchsorted(edges, values) + np.searchsorted(edges, values, "right")
            size = 2 * len(edges) + 1
            for part in np.unique(of):
                mine = of == part
                v, c = values[mine], cell[mine]
                key = (at, int(part))
                if key not in found:
                    found[key] = [np.zeros(size, "i8"), np.full(size, np.inf), np.full(size, -np.inf)]
                counts, low, high = found[key]
                counts += np.bincount(c, minlength=size)
                np.minimum.at(low, c, v)
                np.maximum.at(high, c, v)
    task = TaskContext.get().partitionId()
    for (at, part), arrays in found.items():
        row = [pa.array([n], pa.int32()) for n in (at, part, task)]
        yield pa.RecordBatch.from_arrays(
            [*row, *[pa.array([a.tobytes()], pa.binary()) for a in arrays]], ["at", "part", "task", "counts", "low", "high"]
        )


def _merged(key: tuple, table: pa.Table) -> pa.Table:
    def of(name: str, kind: str) -> np.ndarray:
        return np.stack([np.frombuffer(v.as_py(), kind) for v in table.column(name)])

    arrays = [of("counts", "i8").sum(0), of("low", "f8").min(0), of("high", "f8").max(0)]
    return pa.table(
        [pa.array([k.as_py()], pa.int32()) for k in key] + [pa.array([0], pa.int32())]
        + [pa.array([a.tobytes()], pa.binary()) for a in arrays], ["at", "part", "task", "counts", "low", "high"],
    )


def quantiles_without(
    df: DataFrame, columns: dict[str, Column], part: Column, left_out: Sequence[int | None], prob: float = 0.5
) -> list[dict[str, tuple[float | None, int]]]:
    """Per left-out part (None: none of them) and column the exact interpolated quantile of the
    other parts' values, and how many of them there are.

    All columns and parts share a pass: values are counted by cell, the cells between the cuts of a
    sample first. A cell with a wanted rank and more than one value is cut anew, in equal steps of
    the number's bits, so a few passes settle any column. A row a column and part, of some hundred
    counts, reaches the driver; nothing is sorted or shuffled but these counts.
    """
    names = list(columns)
    rows = df.select(*[_clean(columns[c]).alias(f"c{i}") for i, c in enumerate(names)], part.cast("int").alias("part"))
    share = _SAMPLE / max(df.count(), 1)
    some = (rows if share >= 1 else rows.sample(share, 1)).toArrow()
    cuts = []
    for i in range(len(names)):
        values = some.column(i).to_numpy()
        values = np.sort(values[~np.isnan(values)] + 0.0)
        at = np.linspace(0, len(values) - 1, _CELLS).astype(int) if len(values) else []
        cuts.append(np.unique(values[at]))
    result: list[dict] = [{} for _ in left_out]
    wanted: dict[tuple[int, int], dict[int, float | None]] = {}
    asked = list(range(len(names)))
    first = True
    while asked:
        counted = rows.select(*[f"c{i}" for i in asked], "part").mapInArrow(
            partial(_counted, [cuts[i] for i in asked]), _COUNTS
        ).groupBy("at", "part").applyInArrow(_merged, _COUNTS)
        tables: dict[int, dict[int, list[np.ndarray]]] = {i: {} for i in asked}
        for r in counted.collect():  # a row a column and part
            tables[asked[r["at"]]][r["part"]] = [
                np.frombuffer(r[c], k) for c, k in (("counts", "i8"), ("low", "f8"), ("high", "f8"))
            ]
        again = []
        for i in asked:
            ranges = set()
            for k, out in enumerate(left_out):
                mine = [t for p, t in tables[i].items() if out is None or p != out]
                counts = np.sum([t[0] for t in mine], axis=0) if mine else np.zeros(1, "i8")
                if first:
                    at = prob * (int(counts.sum()) - 1)
                    wanted[i, k] = {r: None for r in (math.floor(at), math.ceil(at))} if counts.sum() else {}
                    result[k][names[i]] = (None, int(counts.sum()))
                upto = np.cumsum(counts)
                for rank, value in wanted[i, k].items():
                    if value is not None:
                        continue
                    cell = int(np.searchsorted(upto, rank, "right"))
                    low, high = min(t[1][cell] for t in mine), max(t[2][cell] for t in mine)
                    if low == high:
                        wanted[i, k][rank] = float(low)
                    else:
                        ranges.add((low, high))
            if ranges:
                again.append(i)
                each = max(2, _CELLS // len(ranges))
                edges = []
                for low, high in ranges:
                    a, b = (int(x) for x in _steps(np.array([low, high])))
                    edges.append(_values(np.array([a + (b - a) * j // each for j in range(each + 1)], "i8")))
                cuts[i] = np.unique(np.concatenate(edges))
        asked, first = again, False
    for (i, k), found in wanted.items():
        if found:
            n = result[k][names[i]][1]
            result[k][names[i]] = (_interpolated(n, found, prob), n)
    return result


def _ranked_quantiles(df: DataFrame, keys: list[str], value: str, probs: Sequence[float]) -> DataFrame:
    """Quantiles of very large groups: equal values are merged, the rest is ranged over all
    partitions by (keys, value), and running counts locate the wanted ranks."""
    weighted = (
        df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("__w"))
    )
    placed = stored(running_total(weighted, [*keys, value], "__w", "__end"))
    bounds = placed.groupBy(*keys).agg(
        F.min(F.col("__end") - F.col("__w")).alias("__first"), F.sum("__w").alias("__n")
    )
    placed = placed.join(bounds, keys)
    start = F.col("__end") - F.col("__w") - F.col("__first")
    end = F.col("__end") - F.col("__first")

    def element(rank: Column) -> Column:
        return F.max(F.when((start <= rank) & (rank < end), F.col(value)))

    aggs = []
    for i, p in enumerate(probs):
        at = F.lit(p) * (F.col("__n") - 1)
        aggs += [element(F.floor(at)).alias(f"__lo{i}"), element(F.ceil(at)).alias(f"__hi{i}")]
    picked = placed.groupBy(*keys, "__n").agg(*aggs)
    parts = []
    for i, p in enumerate(probs):
        at = F.lit(p) * (F.col("__n") - 1)
        low, high = F.col(f"__lo{i}"), F.col(f"__hi{i}")
        parts.append(low + (high - low) * (at - F.floor(at)))
    return picked.select(*keys, F.array(*parts).alias(value))


def group_quantiles(
    df: DataFrame, keys: list[str], values: list[str], probs: Sequence[float],
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Per group and value column an array of interpolated quantiles (NULL if no value).

    Keys must not be NULL.
    """
    levels = F.array(*[F.lit(p) for p in probs])
    exact = [F.percentile(F.col(v), levels).alias(v) for v in values]
    sizes = df.groupBy(*keys).agg(F.count("*").alias("__n"))
    hot = sizes.where(F.col("__n") > hot_rows).select(*keys)
    if hot.isEmpty():
        return df.groupBy(*keys).agg(*exact)
    hot = stored(hot)
    marker = bounded_broadcast(hot)
    cold = df.join(marker, keys, "left_anti").groupBy(*keys).agg(*exact)
    large = stored(df.join(marker, keys, "left_semi").select(*keys, *values))
    result = hot
    for value in values:
        result = result.join(_ranked_quantiles(large, keys, value, probs), keys, "left")
    return cold.unionByName(result)
