"""Boosted regression trees of several training sets over one table of bin codes.

The models of a cross-fit differ only in the fold they leave out, so they grow side by side: the
rows are coded once, in blocks, and a pass over the blocks sums residuals by model, node, column
and code for all of them. A pass makes one level of one tree of every model; the sums of a node
meet in one group, which picks its split. Only splits reach the driver.

The method is that of MLlib's ``GBTRegressor`` with squared loss: the first tree counts whole,
later ones fit twice the residual and count ``learning_rate``; cuts are taken from a sample of the
model's own rows, rows are drawn anew for every tree and features for every node. The trees end as
an MLlib model, which scores and is saved as any other.
"""

from __future__ import annotations

import math
import sys
import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loamline.session import remove, scratch_dir

MAX_BINS = 64
SAMPLE_ROWS = 20_000  # rows that cuts are taken from
BLOCK_ROWS = 16_384
FOLD_IN = 10  # rounds after which the scores of the rows are stored again
_EPSILON = 2.3e-16

# The models' queries also run where only the driver has the package on its path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass(frozen=True)
class Inputs:
    """What one model takes in: fill-ins, columns with a gap flag, and the names of categories."""

    medians: dict[str, float]
    modes: dict[str, str]
    indicators: list[str]
    labels: dict[str, list[str]]
    #: The fold that the model does not see; None: it sees all rows.
    holdout: int | None = None
    #: All columns that were looked at, also those that carry nothing.
    asked: tuple[str, ...] = ()

    @property
    def width(self) -> int:
        return len(self.medians) + len(self.indicators) + sum(len(v) for v in self.labels.values())

    def joined(self, other: Inputs, features: Sequence[str]) -> Inputs:
        """Inputs of both, in the order of ``features``."""
        def ordered(a: dict, b: dict) -> dict:
            both = a | b
            return {c: both[c] for c in features if c in both}

        flagged = {*self.indicators, *other.indicators}
        return Inputs(
            ordered(self.medians, other.medians), ordered(self.modes, other.modes),
            [c for c in features if c in flagged], ordered(self.labels, other.labels), self.holdout, tuple(features),
        )


# --- codes -----------------------------------------------------------------------------

@dataclass
class _Coding:
    """Codes of the columns that any model takes in. A number's code is the place of its value among
    the cuts of all models, a category's that of its name; the code above them all is a gap."""

    numbers: list[str]
    names: list[str]
    edges: list[np.ndarray]
    labels: list[list[str]]

    @property
    def sizes(self) -> list[int]:
        return [len(e) + 2 for e in self.edges] + [len(v) + 1 for v in self.labels]

    @property
    def kind(self) -> str:
        return "u1" if max(self.sizes, default=0) <= 256 else "u2" if max(self.sizes) <= 65_536 else "u4"


def cuts(values: np.ndarray, most: int = MAX_BINS - 1) -> np.ndarray:
    """Midpoints between neighbouring values, all of them or ``most`` that part the rows evenly."""
    distinct, counts = np.unique(values, return_counts=True)
    if len(distinct) < 2:
        return np.empty(0)
    if len(distinct) - 1 <= most:
        at = np.arange(len(distinct) - 1)
    else:
        upto = np.cumsum(counts)
        wanted = np.arange(1, most + 1) * (len(values) / (most + 1))
        after = np.clip(np.searchsorted(upto, wanted), 0, len(distinct) - 2)
        before = np.maximum(after - 1, 0)
        at = np.unique(np.where(np.abs(upto[before] - wanted) < np.abs(upto[after] - wanted), before, after))
    return (distinct[at] + distinct[at + 1]) / 2


def _own_cuts(sample: pa.Table, models: Sequence[Inputs]) -> list[dict[str, np.ndarray]]:
    fold = sample.column("fold").to_numpy()
    found = []
    for m in models:
        seen = np.ones(len(fold), bool) if m.holdout is None else fold != m.holdout
        found.append({})
        for c, median in m.medians.items():
            values = sample.column(c).to_numpy()[seen]
            found[-1][c] = cuts(np.where(np.isnan(values), median, values))
    return found


_BLOCKS = "codes binary, fold binary, label binary, key binary, scores binary"


def _encode(coding: _Coding, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, whole.num_rows, BLOCK_ROWS):
            batch = whole.slice(at, BLOCK_ROWS)
            column = lambda c: batch.column(batch.schema.get_field_index(c))  # noqa: B023, E731
            codes = np.empty((len(coding.sizes), batch.num_rows), coding.kind)
            for i, (c, edges) in enumerate(zip(coding.numbers, coding.edges)):
                values = column(c).to_numpy(zero_copy_only=False).astype(float)
                codes[i] = np.where(np.isnan(values), len(edges) + 1, np.searchsorted(edges, values))
            for i, (c, labels) in enumerate(zip(coding.names, coding.labels), len(coding.numbers)):
                found = pc.index_in(column(c), pa.array(labels, column(c).type))
                codes[i] = found.fill_null(len(labels)).to_numpy(zero_copy_only=False)
            label = column("__label").to_numpy(zero_copy_only=False).astype(float)
            if np.isnan(label).any():
                raise ValueError("a training row has no label")
            parts = [codes, column("fold").to_numpy().astype("i4"), label, column("__key").to_numpy()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([p.tobytes()], pa.binary()) for p in parts] + [pa.array([b""], pa.binary())],
                ["codes", "fold", "label", "key", "scores"],
            )


# --- trees -----------------------------------------------------------------------------

@dataclass
class _Tree:
    """A tree of full depth: a node that is not split sends all rows left. ``left[node]`` says by
    code where a row goes."""

    depth: int
    width: int
    column: np.ndarray = field(init=False)
    left: np.ndarray = field(init=False)
    value: np.ndarray = field(init=False)
    #: Node -> (rows, sum, sum of squares), and node -> (feature, threshold, gain) where split.
    stats: dict = field(default_factory=dict)
    splits: dict = field(default_factory=dict)

    def __post_init__(self) -> None:
        nodes = 2 ** self.depth - 1
        self.column, self.left = np.zeros(nodes, np.intp), np.ones((nodes, self.width), bool)
        self.value = np.zeros(nodes + 1)

    def route(self, codes: np.ndarray, depth: int) -> np.ndarray:
        """The place of each row among the nodes at ``depth``."""
        n = codes.shape[1]
        place, flat, left, rows = np.zeros(n, np.intp), codes.ravel(), self.left.ravel(), np.arange(n)
        for level in range(depth):
            if level:
                node = place + (2 ** level - 1)
                went = left[node * self.width + flat[self.column[node] * n + rows]]
            else:
                went = self.left[0][codes[self.column[0]]]
            place = 2 * place + ~went
        return place

    def settle(self, weight: float) -> None:
        """Values of the leaves, times the weight of the tree."""
        for node in self.stats:
            if node not in self.splits:
                level = (node + 1).bit_length() - 1
                span = 2 ** (self.depth - level)
                first = (node - (2 ** level - 1)) * span
                self.value[first:first + span] = weight * self.mean(node)

    def mean(self, node: int) -> float:
        n, total, _ = self.stats[node]
        return total / n if n else 0.0

    def impurity(self, node: int) -> float:
        n, total, squares = self.stats[node]
        return max(0.0, squares / n - (total / n) ** 2) if n else 0.0


@dataclass
class _Pass:
    """What the tasks need: the trees since the scores were stored, and the level that is made now."""

    shape: tuple[list[int], str]
    holdouts: list[int | None]
    pending: list[list[_Tree]]
    growing: list[_Tree]
    #: Nodes of each model at the level that may still be split, by their place in it.
    open: list[list[int]]
    level: int
    round: int
    subsample: float
    seed: int

    def block(self, batch: pa.RecordBatch, i: int) -> dict[str, np.ndarray]:
        sizes, kind = self.shape
        raw = {c: batch.column(batch.schema.get_field_index(c))[i].as_py() for c in batch.schema.names}
        label = np.frombuffer(raw["label"])
        scores = np.frombuffer(raw["scores"]) if raw["scores"] else np.zeros(len(self.holdouts) * len(label))
        return {
            "codes": np.frombuffer(raw["codes"], kind).reshape(len(sizes), -1), "label": label,
            "fold": np.frombuffer(raw["fold"], "i4"), "key": np.frombuffer(raw["key"], "u8"),
            "scores": scores.reshape(len(self.holdouts), -1),
        }

    def score(self, m: int, codes: np.ndarray, start: np.ndarray) -> np.ndarray:
        for tree in self.pending[m]:
            start = start + tree.value[tree.route(codes, tree.depth)]
        return start

    def drawn(self, key: np.ndarray) -> np.ndarray:
        """Rows drawn for the tree: by hash of the row's key and the round, the same on any partition."""
        if self.subsample >= 1:
            return np.ones(len(key), bool)
        z = key + np.uint64((self.seed + self.round) * 0x9E3779B97F4A7C15 % 2 ** 64)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return (z ^ (z >> np.uint64(31))) >> np.uint64(11) < np.uint64(self.subsample * 2 ** 53)


_SUMS = "model int, node int, part int, sums binary"


def _offsets(sizes: Sequence[int]) -> np.ndarray:
    """Where a column's sums begin, behind the three of the node; the last is their number."""
    return 3 + 3 * np.concatenate([[0], np.cumsum(sizes)]).astype(int)


def _summed(step: _Pass, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows, sum and sum of squares of the residuals by model, open node, column and code."""
    from pyspark import TaskContext

    sizes = step.shape[0]
    offsets = _offsets(sizes)
    sums = [np.zeros((len(places), offsets[-1])) for places in step.open]
    slots = []
    for places in step.open:
        slots.append(np.full(2 ** step.level, -1, np.intp))
        slots[-1][places] = np.arange(len(places))
    for batch in batches:
        for i in range(batch.num_rows):
            block = step.block(batch, i)
            drawn = step.drawn(block["key"])
            for m, holdout in enumerate(step.holdouts):
                if not step.open[m]:
                    continue
                rows = np.flatnonzero(drawn if holdout is None else drawn & (block["fold"] != holdout))
                codes, y = block["codes"][:, rows], block["label"][rows]
                r = 2 * (y - step.score(m, codes, block["scores"][m][rows])) if step.round else y
                slot = slots[m][step.growing[m].route(codes, step.level)]
                if slot.min(initial=0) < 0:
                    kept = np.flatnonzero(slot >= 0)
                    codes, r, slot = codes[:, kept], r[kept], slot[kept]
                of, n = sums[m], len(step.open[m])
                weights = (None, r, r * r)
                for k, w in enumerate(weights):
                    of[:, k] += np.bincount(slot, w, n)
                for c, size in enumerate(sizes):
                    cell = slot * size + codes[c]
                    for k, w in enumerate(weights):
                        at = offsets[c] + k * size
                        of[:, at:at + size] += np.bincount(cell, w, n * size).reshape(n, size)
    part = TaskContext.get().partitionId()
    rows = [(m, place, part, of[i].tobytes()) for m, of in enumerate(sums) for i, place in enumerate(step.open[m])]
    if rows:
        types = (pa.int32(), pa.int32(), pa.int32(), pa.binary())
        yield pa.RecordBatch.from_arrays(
            [pa.array(v, t) for v, t in zip(zip(*rows), types)], ["model", "node", "part", "sums"]
        )


@dataclass
class _Candidates:
    """The splits one model may make: per feature the column, its kind and its cuts."""

    #: (kind, column, cuts): places among the column's edges, or the codes that go right.
    features: list[tuple[str, int, list]]
    #: Code of the median, or of the most frequent name, by column.
    fill: dict[int, int]
    thresholds: list[list[float]]

    def lefts(self, sizes: Sequence[int], feature: int) -> np.ndarray:
        """Per cut of a feature and code of its column, whether a row goes left."""
        kind, column, at = self.features[feature]
        codes = np.arange(sizes[column])
        if kind == "gap":
            return (codes != sizes[column] - 1)[None]
        filled = np.where(codes == sizes[column] - 1, self.fill[column], codes)
        if kind == "number":
            return filled[None] <= np.array(at, np.intp)[:, None]
        return filled[None] != np.array(at, np.intp)[:, None]


def _candidates(inputs: Inputs, coding: _Coding, own: dict[str, np.ndarray]) -> _Candidates:
    features, thresholds, fill = [], [], {}
    for c, median in inputs.medians.items():
        i = coding.numbers.index(c)
        fill[i] = int(np.searchsorted(coding.edges[i], median))
        features.append(("number", i, np.searchsorted(coding.edges[i], own[c]).tolist()))
        thresholds.append(own[c].tolist())
    for c in inputs.indicators:
        features.append(("gap", coding.numbers.index(c), [0]))
        thresholds.append([0.5])
    for c, labels in inputs.labels.items():
        i = len(coding.numbers) + coding.names.index(c)
        place = {v: k for k, v in enumerate(coding.labels[i - len(coding.numbers)])}
        fill[i] = place[inputs.modes[c]]
        features += [("name", i, [place[v]]) for v in labels]
        thresholds += [[0.5]] * len(labels)
    return _Candidates(features, fill, thresholds)


_SPLIT = (
    "model int, node int, feature int, cut int, gain double, stats array<double>, left array<double>"
)


def _best(
    sizes: Sequence[int], models: Sequence[_Candidates], colsample: float, min_leaf: int, seed: int, key: tuple, table: pa.Table
) -> pa.Table:
    """The best split of a node from the sums of all tasks, or none (feature −1)."""
    m, node = key[0].as_py(), key[1].as_py()
    order = np.argsort(table.column("part").to_numpy())
    parts = table.column("sums")
    total = np.sum([np.frombuffer(parts[int(i)].as_py()) for i in order], axis=0)
    offsets, stats, own = _offsets(sizes), total[:3], models[m]
    best = (0.0, -1, 0, np.zeros(3))
    if stats[0] and stats[2] / stats[0] - (stats[1] / stats[0]) ** 2 > _EPSILON:
        rng = np.random.default_rng([seed, m, node])
        wanted = math.ceil(colsample * len(own.features))
        for j in np.sort(rng.permutation(len(own.features))[:wanted]):
            column = own.features[j][1]
            sums = total[offsets[column]:offsets[column + 1]].reshape(3, -1)
            lefts = own.lefts(sizes, j) @ sums.T  # a row a cut: rows, sum, squares
            rights = stats - lefts
            fits = (lefts[:, 0] >= min_leaf) & (rights[:, 0] >= min_leaf)
            if not fits.any():
                continue
            with np.errstate(divide="ignore", invalid="ignore"):
                apart = lefts[:, 1] ** 2 / lefts[:, 0] + rights[:, 1] ** 2 / rights[:, 0]
            gain = np.where(fits, (apart - stats[1] ** 2 / stats[0]) / stats[0], -1.0)
            at = int(np.argmax(gain))
            if gain[at] > best[0]:
                best = (float(gain[at]), int(j), at, lefts[at])
    row = ([m], [node], [best[1]], [best[2]], [best[0]], [stats.tolist()], [best[3].tolist()])
    types = (*[pa.int32()] * 4, pa.float64(), pa.list_(pa.float64()), pa.list_(pa.float64()))
    return pa.table(
        [pa.array(v, t) for v, t in zip(row, types)], ["model", "node", "feature", "cut", "gain", "stats", "left"]
    )


def _chooser(*settings) -> Callable[[tuple, pa.Table], pa.Table]:
    def best(key: tuple, table: pa.Table) -> pa.Table:
        return _best(*settings, key, table)

    return best


def _grown(
    blocks: DataFrame, step: _Pass, candidates: Sequence[_Candidates], params, depth: int
) -> list[_Tree]:
    """The next tree of every model, a pass a level."""
    sizes = step.shape[0]
    step.growing = [_Tree(depth, max(sizes, default=1)) for _ in candidates]
    step.open = [[0] for _ in candidates]
    for level in range(depth):
        step.level = level
        seed = (step.seed + step.round) * 64 + level
        best = _chooser(sizes, candidates, params.colsample, params.min_leaf, seed)

        found = blocks.mapInArrow(partial(_summed, step), _SUMS).groupBy("model", "node").applyInArrow(best, _SPLIT)
        opened = [[] for _ in candidates]
        for r in sorted(found.collect(), key=lambda r: (r["model"], r["node"])):  # a row a model and node
            tree, node = step.growing[r["model"]], 2 ** level - 1 + r["node"]
            stats, left = np.array(r["stats"]), np.array(r["left"])
            tree.stats[node] = tuple(stats.tolist())
            if r["feature"] < 0:
                continue
            own = candidates[r["model"]]
            column = own.features[r["feature"]][1]
            tree.column[node] = column
            tree.left[node, :sizes[column]] = own.lefts(sizes, r["feature"])[r["cut"]]
            tree.splits[node] = (r["feature"], own.thresholds[r["feature"]][r["cut"]], r["gain"])
            for side, part in ((0, left), (1, stats - left)):
                child = 2 * node + 1 + side
                tree.stats[child] = tuple(part.tolist())
                if tree.impurity(child) > _EPSILON and part[0] >= 2 * params.min_leaf:
                    opened[r["model"]].append(2 * r["node"] + side)
        step.open = opened
        if not any(opened):
            break
    return step.growing


def _rescored(step: _Pass, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The blocks with the scores of all trees so far."""
    for batch in batches:
        for i in range(batch.num_rows):
            block = step.block(batch, i)
            scores = [step.score(m, block["codes"], block["scores"][m]) for m in range(len(step.holdouts))]
            columns = [batch.column(k).slice(i, 1) for k in range(4)]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array([np.stack(scores).tobytes()], pa.binary())], batch.schema.names
            )


def _written(df: DataFrame) -> tuple[DataFrame, str]:
    uri = f"{scratch_dir(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(uri)
    return df.sparkSession.read.schema(_BLOCKS).parquet(uri), uri


def boosted(
    rows: DataFrame, numbers: dict[str, Column], names: Sequence[str], label: Column, models: Sequence[Inputs], params,
    seed: int,
) -> list[GBTRegressionModel]:
    """A model for each of ``models``, over the inputs' vector: medians, gap flags, names.

    ``rows`` are scanned twice, for the cuts and for the codes, and should be stored; with
    holdouts they carry ``fold``. Rows are told apart by ``obs_id`` where they have one.
    """
    spark = rows.sparkSession
    used = [c for c in numbers if any(c in m.medians for m in models)]
    named = [c for c in names if any(c in m.labels for m in models)]
    fold = F.col("fold").cast("int") if "fold" in rows.columns else F.lit(-1)
    key = F.xxhash64("obs_id") if "obs_id" in rows.columns else F.xxhash64(F.monotonically_increasing_id())
    wide = rows.select(
        *[numbers[c].alias(c) for c in used], *[F.col(c).cast("string").alias(c) for c in named],
        label.alias("__label"), fold.alias("fold"), key.alias("__key"),
    )
    share = SAMPLE_ROWS / max(rows.count(), 1)
    some = wide if share >= 1 else wide.sample(share, seed)
    own = _own_cuts(some.select(*used, "fold").toArrow(), models)
    coding = _Coding(
        used, named, [np.unique(np.concatenate([o[c] for o in own if c in o])) for c in used],
        [sorted({v for m in models for v in m.labels.get(c, ())}) for c in named],
    )
    candidates = [_candidates(m, coding, o) for m, o in zip(models, own)]
    blocks, uri = _written(wide.mapInArrow(partial(_encode, coding), _BLOCKS))
    step = _Pass(
        (coding.sizes, coding.kind), [m.holdout for m in models], [[] for _ in models], [], [], 0, 0, params.subsample, seed
    )
    trees = [[] for _ in models]
    for step.round in range(params.rounds):
        if len(step.pending[0]) >= FOLD_IN:
            old = uri
            blocks, uri = _written(blocks.mapInArrow(partial(_rescored, step), _BLOCKS))
            remove(spark, old)
            step.pending = [[] for _ in models]
        weight = params.learning_rate if step.round else 1.0
        for own_trees, pending, tree in zip(trees, step.pending, _grown(blocks, step, candidates, params, params.max_depth)):
            tree.settle(weight)
            own_trees.append(tree)
            pending.append(tree)
    remove(spark, uri)
    return [_as_mllib(spark, grown, m.width, params.learning_rate) for grown, m in zip(trees, models)]


def _as_mllib(spark: SparkSession, trees: Sequence[_Tree], width: int, rate: float) -> GBTRegressionModel:
    sc = spark.sparkContext
    jvm, gateway = sc._jvm, sc._gateway
    ml = jvm.org.apache.spark.ml

    def node(tree: _Tree, at: int):
        stats = gateway.new_array(jvm.double, 3)
        for k, v in enumerate(tree.stats[at]):
            stats[k] = float(v)
        found = jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator(stats, int(tree.stats[at][0]))
        mean, impurity = float(tree.mean(at)), float(tree.impurity(at))
        if at not in tree.splits:
            return ml.tree.LeafNode(mean, impurity, found)
        feature, threshold, gain = tree.splits[at]
        return ml.tree.InternalNode(
            mean, impurity, float(gain), node(tree, 2 * at + 1), node(tree, 2 * at + 2),
            ml.tree.ContinuousSplit(int(feature), float(threshold)), found,
        )

    kind = ml.regression.DecisionTreeRegressionModel
    grown, weights = gateway.new_array(kind, len(trees)), gateway.new_array(jvm.double, len(trees))
    for i, tree in enumerate(trees):
        grown[i] = kind(f"dtr_{uuid.uuid4().hex[:12]}", node(tree, 0), width)
        weights[i] = rate if i else 1.0
    return GBTRegressionModel(ml.regression.GBTRegressionModel(f"gbtr_{uuid.uuid4().hex[:12]}", grown, weights, width))
