"""Metrics, conformal intervals, histograms."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import standins as S
from checks.registry import query, round_all, rounded
from loamline.operators import conformal, metrics, quantiles

PIXEL_X = "CAST(floor(6378137.0::DOUBLE * radians(lon) / 250) AS BIGINT)"
PIXEL_Y = (
    "CAST(floor(6378137.0::DOUBLE * ln(tan(0.7853981633974483::DOUBLE + radians(greatest(least(lat, "
    "85.05112878::DOUBLE), -85.05112878::DOUBLE)) / 2)) / 250) AS BIGINT)"
)


def metrics_sql(source: str, by: str = "", having: str = "") -> str:
    lead = f"{by}, " if by else ""
    group = f"GROUP BY {by} {having}" if by else ""
    return f"""SELECT {lead}count(e) AS n,
      round(CASE WHEN count(e) > 1 THEN 1 - sum(e * e) / (count(e) * var_pop(y)) END, 6) + 0.0 AS r2,
      round(sqrt(avg(e * e)), 6) + 0.0 AS rmse, round(avg(abs(e)), 6) + 0.0 AS mae,
      round(avg(e), 6) + 0.0 AS bias, round(avg(y), 6) + 0.0 AS mean_observed,
      round(avg(q), 6) + 0.0 AS mean_predicted
      FROM (SELECT *, CASE WHEN observed IS NOT NULL AND predicted IS NOT NULL THEN predicted - observed END AS e,
              CASE WHEN predicted IS NOT NULL THEN observed END AS y,
              CASE WHEN observed IS NOT NULL THEN predicted END AS q FROM {source}) {group}"""


PIXELS = f"""pixels AS (
  SELECT {PIXEL_X} AS pixel_x_250m, {PIXEL_Y} AS pixel_y_250m, CAST(floor(z_mid / 10) AS BIGINT) AS depth_bin_10cm,
         avg(observed) AS observed, avg(predicted) AS predicted, count(*) AS n_horizons
  FROM pairs GROUP BY ALL)"""


@query(
    "A21_pixel_depth",
    f"""WITH {S.PAIRS}, {PIXELS} SELECT pixel_x_250m, pixel_y_250m, depth_bin_10cm,
        round(observed, 6) + 0.0 AS observed, round(predicted, 6) + 0.0 AS predicted, n_horizons FROM pixels""",
)
def pixel_depth(spark, sf):
    return round_all(metrics.pixel_depth(S.pairs(spark, sf)))


@query("A22_regression_metrics", f"WITH {S.PAIRS} {metrics_sql('pairs', 'dataset')}")
def regression_metrics(spark, sf):
    return round_all(metrics.regression_metrics(S.pairs(spark, sf), ["dataset"]))


@query(
    "A23_subgroup_metrics",
    f"""WITH {S.PAIRS}, grouped AS (SELECT *, CASE WHEN l_suppkey % 2 = 0 THEN l_partkey END AS grp FROM pairs)
        {metrics_sql('grouped', 'grp', 'HAVING count(*) >= 30')}""",
)
def subgroup_metrics(spark, sf):
    grouped = S.pairs(spark, sf).withColumn(
        "grp", F.when(F.col("l_suppkey") % 2 == 0, F.col("l_partkey"))
    )
    return round_all(metrics.subgroup_metrics(grouped, "grp"))


BOUNDED = """bounded AS (
  SELECT *, CASE WHEN predicted - 2.5::DOUBLE * scale < 0 THEN 0 ELSE predicted - 2.5::DOUBLE * scale END AS lower_90,
         predicted + 2.5::DOUBLE * scale AS upper_90 FROM pairs)"""


def interval_sql(source: str, by: str = "") -> str:
    lead = f"{by}, " if by else ""
    group = f"GROUP BY {by}" if by else ""
    return f"""SELECT {lead}count(*) AS n,
      round(avg(CASE WHEN observed BETWEEN lower_90 AND upper_90 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 6) + 0.0 AS coverage_90,
      round(avg(upper_90 - lower_90), 6) + 0.0 AS mean_interval_width,
      round(median(upper_90 - lower_90), 6) + 0.0 AS median_interval_width,
      round(avg(lower_90), 6) + 0.0 AS mean_lower, round(avg(upper_90), 6) + 0.0 AS mean_upper
      FROM {source} WHERE observed IS NOT NULL AND predicted IS NOT NULL AND lower_90 IS NOT NULL
        AND upper_90 IS NOT NULL {group}"""


def bounded(spark, sf):
    return conformal.add_intervals(S.pairs(spark, sf), 2.5)


@query("A24_interval_metrics", f"WITH {S.PAIRS}, {BOUNDED} {interval_sql('bounded')}")
def interval_metrics(spark, sf):
    return round_all(metrics.interval_metrics(bounded(spark, sf)))


@query(
    "A24_M11_uncertainty_by_depth",
    f"""WITH {S.PAIRS}, {BOUNDED}, grouped AS (
          SELECT *, CASE WHEN z_mid < 30 THEN '0–30 cm' ELSE '>30 cm' END AS depth_group FROM bounded)
        {interval_sql('grouped', 'dataset, depth_group')}""",
)
def uncertainty_by_depth(spark, sf):
    return round_all(metrics.uncertainty_by_depth(bounded(spark, sf), ["dataset"]))


@query(
    "A24_hot_group_medians",
    f"""WITH {S.PAIRS} SELECT dataset, round(median(predicted), 6) + 0.0 AS p50,
        round(quantile_cont(predicted, 0.9), 6) + 0.0 AS p90 FROM pairs GROUP BY dataset""",
)
def hot_group_medians(spark, sf):
    """Groups far above the limit of one task: the range-partitioned path."""
    found = quantiles.group_quantiles(
        S.pairs(spark, sf), ["dataset"], ["predicted"], (0.5, 0.9), hot_rows=500
    )
    return round_all(
        found.select("dataset", F.col("predicted")[0].alias("p50"), F.col("predicted")[1].alias("p90"))
    )


def multiplier_sql(where: str = "TRUE", rank: str | None = None) -> str:
    """One-row query of the calibrating score."""
    rank = rank or "least(n - 1, ceil(least(1.0::DOUBLE, ceil((n + 1) * 0.9::DOUBLE) / n) * (n - 1)))"
    return f"""SELECT s AS multiplier, n, CAST({rank} AS BIGINT) AS rank,
        least(1.0::DOUBLE, ceil((n + 1) * 0.9::DOUBLE) / n) AS level FROM (
        SELECT abs(observed - predicted) / scale AS s, count(*) OVER () AS n,
          row_number() OVER (ORDER BY abs(observed - predicted) / scale) - 1 AS i
        FROM pairs WHERE predicted IS NOT NULL AND {where}) WHERE i = {rank}"""


@query(
    "A25_conformal_multiplier",
    f"""WITH {S.PAIRS}, a AS ({multiplier_sql()}),
        b AS ({multiplier_sql(rank="least(n, ceil((n + 1) * 0.9::DOUBLE)) - 1")})
        SELECT 'reference' AS rule, round(multiplier, 6) + 0.0 AS multiplier, n, rank, round(level, 6) + 0.0 AS level FROM a
        UNION ALL SELECT 'textbook', round(multiplier, 6) + 0.0, n, rank, round(level, 6) + 0.0 FROM b""",
)
def conformal_multiplier(spark, sf):
    pairs = S.pairs(spark, sf).select("observed", "predicted", "scale")
    rows = []
    for rule in ("reference", "textbook"):
        fitted = conformal.conformal_multiplier(pairs, 0.9, rule)
        rows.append((rule, fitted["multiplier"], fitted["n"], fitted["rank"], fitted["level"]))
    schema = "rule STRING, multiplier DOUBLE, n BIGINT, rank BIGINT, level DOUBLE"
    return round_all(spark.createDataFrame(rows, schema))


@query(
    "M07_calibrate",
    f"""WITH {S.PAIRS}, m AS ({multiplier_sql("dataset <> 'R'")}), scored AS (
          SELECT p.*, multiplier * scale AS half FROM pairs p CROSS JOIN m WHERE predicted IS NOT NULL)
        SELECT dataset = 'R' AS external, count(*) AS n,
          round(avg(CASE WHEN observed BETWEEN greatest(predicted - half, 0) AND predicted + half
                    THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 6) + 0.0 AS coverage_90,
          round(avg(half), 6) + 0.0 AS half_width FROM scored GROUP BY 1""",
)
def calibrate(spark, sf):
    pairs = S.pairs(spark, sf)
    train, external, _ = conformal.calibrate(
        pairs.where("dataset <> 'R'"), pairs.where("dataset = 'R'")
    )
    both = train.withColumn("external", F.lit(False)).unionByName(
        external.withColumn("external", F.lit(True))
    )
    covered = F.col("observed").between(F.col("lower_90"), F.col("upper_90"))
    return both.where("predicted IS NOT NULL").groupBy("external").agg(
        F.count("*").alias("n"), rounded(F.avg(covered.cast("double"))).alias("coverage_90"),
        rounded(F.avg("half_width_90")).alias("half_width"),
    )


OWN = multiplier_sql("dataset <> 'R'")
EXTERNAL = multiplier_sql("dataset = 'R'")


@query(
    "M08_mapping_multiplier",
    f"""WITH {S.PAIRS}, own AS ({OWN}), ext AS ({EXTERNAL})
        SELECT round(own.multiplier, 6) + 0.0 AS calibration_multiplier,
               round(ext.multiplier, 6) + 0.0 AS mapping_multiplier,
               round(ext.multiplier / own.multiplier, 6) + 0.0 AS mapping_ratio FROM own, ext""",
)
def mapping_multiplier(spark, sf):
    pairs = S.pairs(spark, sf).select("observed", "predicted", "scale", "dataset")
    found = conformal.mapping_multiplier(pairs.where("dataset <> 'R'"), pairs.where("dataset = 'R'"))
    return round_all(spark.createDataFrame([found]).select(*found))


@query(
    "M10_evaluate_run",
    f"""WITH {S.PAIRS}, {PIXELS}, both_ AS (
          SELECT 'rows' AS evaluation, observed, predicted FROM pairs
          UNION ALL SELECT 'pixel x depth', observed, predicted FROM pixels)
        {metrics_sql('both_', 'evaluation')}""",
)
def evaluate(spark, sf):
    from loamline.operators.stack import concat_tagged

    pairs = S.pairs(spark, sf)
    frames = {"rows": pairs, "pixel x depth": metrics.pixel_depth(pairs)}
    both = concat_tagged({k: f.select("observed", "predicted") for k, f in frames.items()}, "evaluation")
    return round_all(metrics.regression_metrics(both, ["evaluation"]))


@query(
    "A30_histogram",
    f"""WITH {S.PAIRS}, c AS (SELECT least(predicted, (SELECT quantile_cont(predicted, 0.99) FROM pairs)) AS v
          FROM pairs WHERE predicted IS NOT NULL), e AS (SELECT min(v) AS low, max(v) AS high FROM c),
        b AS (SELECT CAST(least(floor((v - low) / ((high - low) / 50)), 49) AS BIGINT) AS bin, low, high FROM c, e)
        SELECT k AS bin, round(e.low + k * ((e.high - e.low) / 50), 6) + 0.0 AS low,
               round(e.low + (k + 1) * ((e.high - e.low) / 50), 6) + 0.0 AS high, count(b.bin) AS n
        FROM range(50) r(k) CROSS JOIN e LEFT JOIN b ON b.bin = k GROUP BY k, e.low, e.high""",
)
def histogram(spark, sf):
    return round_all(metrics.histogram(S.pairs(spark, sf), "predicted"))


@query(
    "A31_bin2d",
    f"""WITH {S.PAIRS}, c AS (SELECT observed AS x, predicted AS y FROM pairs WHERE predicted IS NOT NULL),
        e AS (SELECT min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1 FROM c)
        SELECT CAST(least(floor((x - x0) * 45 / (x1 - x0)), 44) AS BIGINT) AS x_bin,
               CAST(least(floor((y - y0) * 45 / (y1 - y0)), 44) AS BIGINT) AS y_bin, count(*) AS n
        FROM c, e GROUP BY ALL""",
)
def bin2d(spark, sf):
    return metrics.bin2d(S.pairs(spark, sf), "observed", "predicted")
