"""Grouped cross-fitted point and error-scale models on MLlib.

MLlib's boosted trees stand in for the gradient boosting library of the published models:
learning rate, depth, rounds, row and column sampling and the minimum leaf size carry over,
leaf penalties do not exist here.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexerModel, VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loamline.functions.clean import depth_group, depth_mid, is_true, measure_range, no_nan, to_number, valid_flag
from loamline.functions.intervals import absolute_error, expm1_clip, floor_scale
from loamline.operators.boosting import MAX_BINS, Inputs, boosted
from loamline.operators.conformal import add_intervals, conformal_multiplier
from loamline.operators.features import contract, contract_table, load_contract
from loamline.operators.metrics import (
    interval_metrics, pixel_depth, regression_metrics, subgroup_metrics, uncertainty_by_depth,
)
from loamline.operators.quantiles import quantiles_without
from loamline.operators.rank import group_folds
from loamline.operators.stack import concat_tagged
from loamline.schema import CATEGORICAL, ContractError, Target, require_columns, require_unique
from loamline.session import checkpointed, stored

SEED = 42
FOLDS = 5
TASK_ROWS = 100_000  # training rows a task takes in one pass
EXPRESSION_WIDTH = 400  # model inputs up to which a vector is one expression


@dataclass(frozen=True)
class Boosting:
    learning_rate: float = 0.03
    max_depth: int = 5
    min_leaf: int = 3
    subsample: float = 0.75
    colsample: float = 0.8
    rounds: int = 500


# Settings of the published models.
POINT = Boosting()
SCALE = Boosting(max_depth=4, min_leaf=5, rounds=350)


# --- tables ----------------------------------------------------------------------------

def prepare_tables(
    train: DataFrame, external: DataFrame, features: Sequence[str], target: Target
) -> tuple[DataFrame, DataFrame]:
    """Numeric target, depth midpoint where absent, row filters, and the feature contract.

    ``obs_id``, ``lat``, ``lon`` and, for training, ``site_id`` must be there.
    """
    def coerce(df: DataFrame) -> DataFrame:
        if "z_mid" not in df.columns and {"top_cm", "bottom_cm"} <= set(df.columns):
            mid = depth_mid(to_number(F.col("top_cm")), to_number(F.col("bottom_cm")))
            df = df.withColumn("z_mid", mid)
        return df.withColumns({c: to_number(F.col(c)) for c in (target.column, "lat", "lon")})

    train, external = coerce(train), coerce(external)
    y = F.col(target.column)
    keep_train, keep_external = y.isNotNull() & F.col("site_id").isNotNull(), y.isNotNull()
    if target.minimum is not None:
        keep_train = keep_train & measure_range(y, target.minimum, target.below or float("inf"))
        keep_external = (
            keep_external & is_true(y >= target.minimum)
            & is_true(F.col("lat").between(-90, 90) & F.col("lon").between(-180, 180))
        )
    if target.valid_flag is not None:
        keep_train = keep_train & valid_flag(F.col(target.valid_flag))
        keep_external = keep_external & valid_flag(F.col(target.valid_flag))
    if target.external_max is not None:
        keep_external = keep_external & is_true(y <= target.external_max)
    for df in (train, external):
        require_columns(df, [*features, "obs_id", target.column], target.name)
    return train.where(keep_train), external.where(keep_external)


# --- preprocessing and boosting --------------------------------------------------------

def number(column: str) -> Column:
    """A numeric feature; NaN counts as missing."""
    return no_nan(F.col(column).cast("double"))


@dataclass
class Fitted:
    """Preprocessor fitted on the training rows, and the regressor on top of it."""

    medians: dict[str, float]
    modes: dict[str, str]
    indicators: list[str]
    pipeline: PipelineModel
    #: What the model was given, until it is saved.
    inputs: Inputs | None = None

    def prepare(self, df: DataFrame) -> DataFrame:
        """Median for a missing number, most frequent category for a missing one, and 0/1
        flags for the columns that had gaps in training."""
        flags = {f"{c}__gap": number(c).isNull().cast("double") for c in self.indicators}
        numbers = {c: F.coalesce(number(c), F.lit(m)) for c, m in self.medians.items()}
        names = {c: F.coalesce(F.col(c).cast("string"), F.lit(m)) for c, m in self.modes.items()}
        return df.withColumns(flags | numbers | names)

    def vector(self) -> Column | None:
        """The pipeline's vector in one expression, which costs a row far less than its stages;
        None where it would be too long."""
        stages = self.pipeline.stages
        labels = {f"{s.getInputCol()}__hot": s.labels for s in stages if isinstance(s, StringIndexerModel)}
        columns = stages[-2].getInputCols()  # a saved map has no order of its own
        if not 0 < sum(len(labels.get(c, "1")) for c in columns) <= EXPRESSION_WIDTH:
            return None
        parts = []
        for column in columns:
            if column in labels:
                name = column.removesuffix("__hot")
                value = F.coalesce(F.col(name).cast("string"), F.lit(self.modes[name]))
                parts += [(value == label).cast("double") for label in labels[column]]
            elif column in self.medians:
                parts.append(F.coalesce(number(column), F.lit(self.medians[column])))
            else:
                parts.append(number(column.removesuffix("__gap")).isNull().cast("double"))
        # A lambda is never part of a stage's generated method. All models of a map in one method are
        # more than the JVM compiles, and would be interpreted.
        apart = F.transform(F.array(parts[0]), lambda v: v)
        return array_to_vector(F.concat(apart, F.array(*parts[1:])) if parts[1:] else apart)

    def transform(self, df: DataFrame, out: str, keep: Sequence[str] | None = None) -> DataFrame:
        """Adds the raw (log-scale) prediction; ``keep`` names the columns to return."""
        keep = list(keep if keep is not None else df.columns)
        vector = self.vector()
        if vector is not None:
            made = df.select(*keep, vector.alias("__features"))
            return self.pipeline.stages[-1].transform(made).select(*keep, F.col("prediction").alias(out))
        # The input columns come back as they were, not as they were imputed.
        raw = {c: f"__raw_{c}" for c in keep if c in {*self.medians, *self.modes}}
        df = df.withColumns({alias: F.col(c) for c, alias in raw.items()})
        scored = self.pipeline.transform(self.prepare(df))
        return scored.select(
            *[F.col(raw.get(c, c)).alias(c) for c in keep], F.col("prediction").alias(out)
        )


def learnt(
    train: DataFrame, features: Sequence[str], categorical: Sequence[str], holdouts: Sequence[int | None] = (None,)
) -> list[Inputs]:
    """Per model the medians, most frequent categories, columns with gaps and category names of the
    rows it sees: those outside the fold it holds out. All models share the passes over ``train``;
    what reaches the driver is a row a fold, and a row a fold and category."""
    names = [c for c in features if c in categorical]
    numbers = {c: number(c) for c in features if c not in categorical}
    by = ["fold"] if any(h is not None for h in holdouts) else []

    fold = F.col("fold") if by else F.lit(0)
    middle = quantiles_without(train, numbers, fold, holdouts)
    sizes = {r["part"]: r["count"] for r in train.groupBy(fold.alias("part")).count().collect()}
    counts = []
    if names:
        cells = train.select(*by, F.posexplode(F.array(*[F.col(c).cast("string") for c in names])).alias("at", "value"))
        counts = cells.where(F.col("value").isNotNull()).groupBy(*by, "at", "value").count().collect()
    found = []
    for i, holdout in enumerate(holdouts):
        # A column without any value carries nothing.
        medians = {c: m for c, (m, _) in middle[i].items() if m is not None}
        rows = sum(n for part, n in sizes.items() if holdout is None or part != holdout)
        indicators = [c for c in medians if middle[i][c][1] < rows]
        modes, labels = {}, {}
        for at, c in enumerate(names):
            sums = {}
            for r in counts:
                if r["at"] == at and (holdout is None or r["fold"] != holdout):
                    sums[r["value"]] = sums.get(r["value"], 0) + r["count"]
            if sums:
                modes[c] = min(sums, key=lambda v: (-sums[v], v))
                labels[c] = sorted(sums, key=lambda v: v.encode("utf-16-be"))
        found.append(Inputs(medians, modes, indicators, labels, holdout))
    return found


def _pipeline(spark: SparkSession, inputs: Inputs, trees: GBTRegressionModel, params: Boosting) -> PipelineModel:
    """Names to 0/1 columns (unseen ones are all zero), the vector, and the trees on it."""
    stages, columns = [], [*inputs.medians, *[f"{c}__gap" for c in inputs.indicators]]
    if inputs.modes:
        named = list(inputs.modes)
        codes, hot = [f"{c}__code" for c in named], [f"{c}__hot" for c in named]
        empty = spark.createDataFrame([], ", ".join(f"`{c}` string" for c in named))
        # One a column: lists of names of different lengths do not go into one.
        for c, code in zip(named, codes):
            stages.append(StringIndexerModel.from_labels(inputs.labels[c], c, code, handleInvalid="keep"))
            empty = stages[-1].transform(empty)
        stages.append(OneHotEncoder(inputCols=codes, outputCols=hot, dropLast=True).fit(empty))
        columns += hot
    settings = GBTRegressor(
        featuresCol="__features", labelCol="__label", lossType="squared",
        maxDepth=params.max_depth, maxIter=params.rounds, stepSize=params.learning_rate,
        subsamplingRate=params.subsample, featureSubsetStrategy=str(params.colsample),
        minInstancesPerNode=params.min_leaf, seed=SEED, maxBins=MAX_BINS,
    )
    return PipelineModel([
        *stages, VectorAssembler(inputCols=columns, outputCol="__features"), settings._copyValues(trees)
    ])


def fit_folds(
    train: DataFrame, features: Sequence[str], label: str, params: Boosting,
    holdouts: Sequence[int | None] = (None,), categorical: Sequence[str] = tuple(CATEGORICAL),
    known: Sequence[Inputs] | None = None,
) -> list[Fitted]:
    """A model for each fold that is held out, and for None one on all rows, grown side by side.

    ``train`` is scanned a few times and should be stored; it carries ``fold`` if there are
    holdouts. ``known`` inputs, learnt from the same rows and holdouts before, are not learnt again.
    """
    spark = train.sparkSession
    old = list(known or [Inputs({}, {}, [], {}, h) for h in holdouts])
    asked = {c for m in old for c in m.asked}
    new = learnt(train, [c for c in features if c not in asked], categorical, holdouts)
    inputs = [a.joined(b, features) for a, b in zip(old, new)]
    numbers = {c: number(c) for c in features if c not in categorical}
    names = [c for c in features if c in categorical]
    grown = boosted(train, numbers, names, F.log1p(F.col(label)), inputs, params, SEED)
    return [
        Fitted(m.medians, m.modes, m.indicators, _pipeline(spark, m, trees, params), m) for m, trees in zip(inputs, grown)
    ]


def fit(
    train: DataFrame, features: Sequence[str], label: str, params: Boosting,
    categorical: Sequence[str] = tuple(CATEGORICAL),
) -> Fitted:
    """Median imputation with gap flags, mode imputation and one-hot (unseen categories are
    all zero), boosted trees on ``log1p(label)``. Everything is learnt from ``train``."""
    return fit_folds(train, features, label, params, (None,), categorical)[0]


def feature_matrix(fitted: Fitted, df: DataFrame, key: str) -> DataFrame:
    """The assembled feature vector per row, as an array."""
    model = PipelineModel(fitted.pipeline.stages[:-1])
    return model.transform(fitted.prepare(df)).select(
        key, vector_to_array("__features").alias("features")
    )


# --- cross-fitting ---------------------------------------------------------------------

def fold_numbers(folded: DataFrame) -> list[int]:
    return sorted(r["fold"] for r in folded.select("fold").distinct().collect())  # k numbers


def score_folds(folded: DataFrame, models: Sequence[Fitted], out: str, keep: Sequence[str]) -> DataFrame:
    """Each row scored by the model that never saw its fold; ``models`` come from ``fit_folds``."""
    parts = [
        m.transform(folded.where(F.col("fold") == m.inputs.holdout), out, keep)
        for m in models if m.inputs.holdout is not None
    ]
    return reduce(DataFrame.unionByName, parts)


def cross_fit(folded: DataFrame, features: Sequence[str], label: str, params: Boosting, out: str) -> DataFrame:
    """Out-of-fold raw predictions: each row is scored by the model that never saw its fold.

    ``folded`` carries ``fold`` and should be stored. Result: obs_id, fold, ``out``.
    """
    models = fit_folds(folded, features, label, params, fold_numbers(folded))
    return score_folds(folded, models, out, ["obs_id", "fold"])


def side_by_side(df: DataFrame, *steps: Callable) -> list:
    """Results of independent steps, whose short stages share the executors."""
    with ThreadPool(len(steps)) as pool:
        return pool.map(inheritable_thread_target(df.sparkSession)(lambda step: step()), steps, 1)


def training_table(df: DataFrame, rows: int, keep: Callable[[DataFrame], DataFrame] = checkpointed) -> DataFrame:
    """``rows`` rows spread by observation id, checkpointed or kept otherwise.

    Training is some hundred short passes over this table, so it has a partition a core, and
    more only where they would be large: a pass over many small ones is spent on their tasks.
    A shuffle's usual number is the bound.
    """
    spark = df.sparkSession
    most = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = max(spark.sparkContext.defaultParallelism, -(-rows // TASK_ROWS))
    return keep(df.repartition(min(most, wanted), "obs_id"))


def with_folds(
    train: DataFrame, k: int = FOLDS, keep: Callable[[DataFrame], DataFrame] = checkpointed
) -> DataFrame:
    return training_table(group_folds(train, "site_id", k), train.count(), keep)


def oof_table(folded: DataFrame, models: Sequence[Fitted], target: Target) -> DataFrame:
    """Observation spine with ``observed``, out-of-fold ``predicted`` and ``fold``."""
    spine = ["obs_id", "site_id", "lat", "lon", "z_mid", target.column, "fold"]
    raw = score_folds(folded, models, "__raw", spine)
    return stored(raw.select(
        "obs_id", "site_id", "lat", "lon", "z_mid", F.col(target.column).alias("observed"), "fold",
        expm1_clip(F.col("__raw")).alias("predicted"),
    ))


def oof_predict(
    folded: DataFrame, features: Sequence[str], target: Target, params: Boosting = POINT
) -> DataFrame:
    """The spine with predictions of models that are fitted for it alone."""
    return oof_table(folded, fit_folds(folded, features, target.column, params, fold_numbers(folded)), target)


def score_external(model: Fitted, external: DataFrame, target: Target) -> DataFrame:
    keep = ["obs_id", "lat", "lon", "z_mid", target.column]
    scored = model.transform(external, "__raw", keep)
    return scored.select(
        "obs_id", "lat", "lon", "z_mid", F.col(target.column).alias("observed"),
        expm1_clip(F.col("__raw")).alias("predicted"),
    )


def join_predictions(features: DataFrame, predictions: DataFrame) -> DataFrame:
    """Adds ``point_prediction`` by observation id; both sides must hold the same rows.

    The one join also finds what either side lacks, so its result is stored.
    """
    side = predictions.select("obs_id", F.col("predicted").alias("point_prediction"), F.lit(True).alias("__scored"))
    joined = stored(features.withColumn("__row", F.lit(True)).join(side, "obs_id", "full"))
    if not joined.where(F.col("__row").isNull() | F.col("__scored").isNull()).isEmpty():
        raise ValueError("feature rows do not align with the saved predictions")
    return joined.drop("__row", "__scored")


@dataclass
class ScaleFit:
    oof: DataFrame
    model: Fitted


def fit_scale(
    folded: DataFrame, oof: DataFrame, features: Sequence[str], target: Target,
    params: Boosting = SCALE, known: Sequence[Inputs] | None = None,
) -> ScaleFit:
    """Error-scale model on out-of-fold absolute errors, with the point prediction as one
    more feature. ``oof`` gets ``scale`` from a second cross-fit over the same folds.

    ``known`` are the point models' inputs, of the sorted folds and then of all rows.
    """
    wide = join_predictions(folded, oof).withColumn(
        "__error", absolute_error(F.col(target.column), F.col("point_prediction"))
    )
    models = fit_folds(
        wide, [*features, "point_prediction"], "__error", params, [*fold_numbers(folded), None], known=known
    )
    spine = ["obs_id", "site_id", "lat", "lon", "z_mid", target.column, "fold", "point_prediction"]
    scaled = score_folds(wide, models, "__raw", spine).select(
        "obs_id", "site_id", "lat", "lon", "z_mid", F.col(target.column).alias("observed"), "fold",
        F.col("point_prediction").alias("predicted"), floor_scale(F.col("__raw"), target.scale_floor).alias("scale"),
    )
    return ScaleFit(stored(scaled), models[-1])


@dataclass
class Bundle:
    """All that serving needs: both models, their inputs, the floor and the multiplier."""

    target: Target
    features: list[str]
    point: Fitted
    scale: Fitted
    multiplier: float

    def score(self, df: DataFrame, keep: Sequence[str]) -> DataFrame:
        """Adds prediction, bounds and width under the target's name."""
        name, keep = self.target.name, list(keep)
        carried = list(dict.fromkeys([*keep, *self.features]))
        points = self.point.transform(df, "__raw", carried).withColumn(
            "point_prediction", expm1_clip(F.col("__raw"))
        )
        scaled = self.scale.transform(points, "__raw2", [*keep, "point_prediction"])
        bounded = add_intervals(
            scaled.withColumns(
                {
                    "predicted": F.col("point_prediction"),
                    "scale": floor_scale(F.col("__raw2"), self.target.scale_floor),
                }
            ),
            self.multiplier,
        )
        return bounded.select(
            *keep, F.col("predicted").alias(f"{name}_prediction"),
            F.col("lower_90").alias(f"{name}_lower_90"), F.col("upper_90").alias(f"{name}_upper_90"),
            F.col("interval_width").alias(f"{name}_interval_width"),
        )


def save_bundle(bundle: Bundle, path: str, spark: SparkSession) -> None:
    """Both pipelines by MLlib's writer, the feature contract, and a table of one row with
    everything else."""
    row = {"target": json.dumps(asdict(bundle.target)), "features": bundle.features, "multiplier": bundle.multiplier}
    for part, fitted in (("point", bundle.point), ("scale", bundle.scale)):
        fitted.pipeline.write().overwrite().save(f"{path}/{part}")
        row |= {
            f"{part}_medians": fitted.medians, f"{part}_modes": fitted.modes, f"{part}_indicators": fitted.indicators
        }
    contract_table(spark, contract(bundle.features)).write.mode("overwrite").parquet(f"{path}/contract")
    spark.createDataFrame([row], _SETTINGS).write.mode("overwrite").parquet(f"{path}/settings")


_SETTINGS = "target string, features array<string>, multiplier double, " + ", ".join(
    f"{part}_medians map<string,double>, {part}_modes map<string,string>, {part}_indicators array<string>"
    for part in ("point", "scale")
)


def load_bundle(spark: SparkSession, path: str) -> Bundle:
    """What ``save_bundle`` wrote, for a job that only scores. A bundle whose contract is not
    the one that tiles are resolved by is refused."""
    row = spark.read.schema(_SETTINGS).parquet(f"{path}/settings").first()
    if load_contract(spark.read.parquet(f"{path}/contract")) != contract(row["features"]):
        raise ContractError(f"{path}: the features were resolved by another contract")
    target = json.loads(row["target"])
    target["features"] = tuple(target["features"])

    def fitted(part: str) -> Fitted:
        return Fitted(
            row[f"{part}_medians"], row[f"{part}_modes"], row[f"{part}_indicators"], PipelineModel.load(f"{path}/{part}")
        )

    return Bundle(Target(**target), row["features"], fitted("point"), fitted("scale"), row["multiplier"])


# --- evaluation ------------------------------------------------------------------------

def evaluate_run(oof: DataFrame, external: DataFrame) -> DataFrame:
    """Row and pixel-by-depth metrics of both evaluations, as rows (dataset, ...)."""
    frames = {
        "grouped OOF rows": oof, "grouped OOF pixel x depth": pixel_depth(oof),
        "external rows": external, "external pixel x depth": pixel_depth(external),
    }
    tagged = concat_tagged({k: f.select("observed", "predicted") for k, f in frames.items()})
    return regression_metrics(tagged, ["dataset"])


def evaluate_intervals(train: DataFrame, external: DataFrame) -> DataFrame:
    bounds = ("observed", "predicted", "lower_90", "upper_90")
    frames = {
        "grouped cross-fit rows": train, "grouped cross-fit pixel x depth": pixel_depth(train, bounds),
        "external rows": external, "external pixel x depth": pixel_depth(external, bounds),
    }
    tagged = concat_tagged({k: f.select(*bounds) for k, f in frames.items()})
    return interval_metrics(tagged, ["dataset"])


def evaluate_parts(oof: DataFrame, train: DataFrame, external: DataFrame) -> dict[str, DataFrame]:
    """Metrics by fold, by depth group of at least 30 rows, and intervals by depth group."""
    columns = ["observed", "predicted", "lower_90", "upper_90", "z_mid"]
    bounds = concat_tagged({
        "grouped cross-fit rows": train.select(*columns), "external rows": external.select(*columns)
    })
    deep = oof.withColumn("depth_group", depth_group(F.col("z_mid")))
    return {
        "fold_metrics": regression_metrics(oof, ["fold"]),
        "depth_metrics": subgroup_metrics(deep, "depth_group"),
        "uncertainty_by_depth": uncertainty_by_depth(bounds, ["dataset"]),
    }


OUTPUTS = (
    "oof", "external", "metrics", "interval_metrics", "fold_metrics", "depth_metrics", "uncertainty_by_depth",
    "mapping_interval_metrics", "manifest",
)


def write_run(run: dict, path: str) -> None:
    """Every table of a run as Parquet below ``path``, and its bundle."""
    for name in OUTPUTS:
        run[name].write.mode("overwrite").parquet(f"{path}/{name}")
    save_bundle(run["bundle"], f"{path}/bundle", run["oof"].sparkSession)


def run_manifest(
    target: Target, train: DataFrame, external: DataFrame, features: Sequence[str],
    metrics: DataFrame, params: dict[str, float], numbers: dict[str, float],
) -> DataFrame:
    """One nested lineage row of a run: sizes, inputs, settings and metric rows."""
    sizes = train.agg(F.count("*").alias("rows"), F.count_distinct("site_id").alias("sites")).first()

    def as_map(values: dict[str, float]):
        return F.create_map(*[F.lit(x) for k, v in values.items() for x in (k, float(v))])

    # A handful of metric rows.
    return metrics.agg(F.sort_array(F.collect_list(F.struct(*metrics.columns))).alias("metrics")).select(
        F.lit(target.name).alias("target"), F.lit(target.units).alias("units"),
        F.lit(sizes["rows"]).cast("bigint").alias("training_rows"),
        F.lit(sizes["sites"]).cast("bigint").alias("training_sites"),
        F.lit(external.count()).cast("bigint").alias("external_rows"),
        F.array(*[F.lit(f) for f in features]).alias("features"),
        F.array(*[F.lit(f) for f in features if f in CATEGORICAL]).alias("categorical_features"),
        as_map(params).alias("params"), as_map(numbers).alias("calibration"), "metrics",
    )


def train_target(
    train: DataFrame, external: DataFrame, features: Sequence[str], target: Target,
    point: Boosting = POINT, scale: Boosting = SCALE, coverage: float = 0.9,
) -> dict:
    """The whole run of one target: folds, point model, scale model, calibration, metrics."""
    train, external = prepare_tables(train, external, features, target)
    folded, external = with_folds(train, keep=stored), stored(external)
    require_unique(folded, "obs_id", "training rows")
    require_unique(external, "obs_id", "external rows")
    models = fit_folds(folded, features, target.column, point, [*fold_numbers(folded), None])
    oof, point_model = oof_table(folded, models, target), models[-1]
    external_points = stored(score_external(point_model, external, target))
    scaled = fit_scale(folded, oof, features, target, scale, [m.inputs for m in models])
    inputs = join_predictions(external, external_points)
    spine = ["obs_id", "lat", "lon", "z_mid", target.column, "point_prediction"]
    external_scored = stored(scaled.model.transform(inputs, "__raw", spine).select(
        "obs_id", "lat", "lon", "z_mid", F.col(target.column).alias("observed"),
        F.col("point_prediction").alias("predicted"), floor_scale(F.col("__raw"), target.scale_floor).alias("scale"),
    ))
    fitted = conformal_multiplier(scaled.oof, coverage)
    numbers = {"calibration_multiplier": fitted["multiplier"], "quantile_level": fitted["level"]}
    serving = fitted["multiplier"]
    if target.external_multiplier:
        serving = conformal_multiplier(external_scored, coverage)["multiplier"]
        numbers["mapping_multiplier"] = serving
        numbers["mapping_ratio"] = serving / fitted["multiplier"]
    train_bounds = add_intervals(scaled.oof, fitted["multiplier"])
    external_bounds = add_intervals(external_scored, fitted["multiplier"])
    metrics = evaluate_run(oof, external_points)
    parts, intervals, mapped = side_by_side(
        folded, lambda: evaluate_parts(oof, train_bounds, external_bounds),
        lambda: evaluate_intervals(train_bounds, external_bounds),
        lambda: evaluate_intervals(add_intervals(scaled.oof, serving), add_intervals(external_scored, serving)),
    )
    return {
        **parts, "mapping_interval_metrics": mapped,
        "oof": train_bounds, "external": external_bounds, "metrics": metrics, "interval_metrics": intervals,
        "bundle": Bundle(target, list(features), point_model, scaled.model, serving),
        "manifest": run_manifest(
            target, folded, external, features, metrics,
            {"learning_rate": point.learning_rate, "max_depth": point.max_depth, "rounds": point.rounds},
            numbers,
        ),
    }
