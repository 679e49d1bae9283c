"""Cross-fitted models and tile scoring."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import functions as F

from checks import standins as S
from checks.evaluation import PIXEL_X, PIXEL_Y
from checks.registry import query, round_all, table
from checks.sources import scratch
from loamline.operators import encode, model, stack
from loamline.operators.conformal import conformal_rank
from loamline.plans import maps
from loamline.schema import DEPTHS_CM, NODATA, TARGETS
from loamline.session import stored
from loamline.sources import snapshots
from loamline.streaming.tiles import score_new_tiles, tile_stream

FEATURES = ["z_mid", "caco3", "bd", "clay_pct", "LRR_group", "LU_scraped"]
# Few and shallow trees: the queries show the job, not the quality of a model.
POINT = model.Boosting(rounds=4, max_depth=3, learning_rate=0.3)
SCALE = model.Boosting(rounds=3, max_depth=2, learning_rate=0.3)
DEPTHS = (5.0, 30.0)


def observations(spark, sf):
    """Every order line, under an id of its own, with features, both targets and the external flag."""
    unique = S.horizons(spark, sf).withColumn(
        "obs_id",
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", (F.col("c_tot") * 4).cast("bigint")),
    )
    region = S.zones(spark, sf).select(F.col("ord").alias("c_nationkey"), "lrr")
    site = table(spark, sf, "customer").join(F.broadcast(region), "c_nationkey").select(  # 25 nations
        F.col("c_custkey").alias("site_id"), F.col("lrr").alias("LRR_group"),
        F.substring("c_mktsegment", 1, 1).alias("segment"),
    )
    land = F.create_map(*[F.lit(x) for x in ("B", "C", "A", "F", "M", "R", "H", "X")])
    return unique.join(site, "site_id").select(
        "obs_id", "site_id", "lat", "lon", "top_cm", "bottom_cm", "caco3", "bd",
        (F.col("l_partkey") % 60).cast("double").alias("clay_pct"), "LRR_group",
        F.try_element_at(land, F.col("segment")).alias("LU_scraped"),
        F.col("c_tot").alias("SOC_pct"), (0.6 + F.col("c_tot") / 10).alias("Measure_BD"),
        F.lit(True).alias("BD_valid_basic"), "l_returnflag",
    )


@lru_cache(maxsize=4)
def sample(spark, sf):
    return stored(observations(spark, sf))


@lru_cache(maxsize=8)
def trained(spark, sf, name):
    """One target's run, made once per session and scale."""
    rows = sample(spark, sf)
    train, external = rows.where("l_returnflag <> 'R'"), rows.where("l_returnflag = 'R'")
    return model.train_target(train, external, FEATURES, TARGETS[name], POINT, SCALE)


OBSERVATIONS = f"""{S.HORIZONS}, obs AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(c_tot * 4 AS BIGINT)) AS obs_id, site_id, lat, lon,
         (top_cm + bottom_cm) / 2 AS z_mid, caco3, bd, CAST(l_partkey % 60 AS DOUBLE) AS clay_pct, c_tot AS y,
         l_returnflag AS flag
  FROM horizons),
named AS (
  SELECT o.*, r_name AS lrr, CASE substr(c_mktsegment, 1, 1) WHEN 'B' THEN 'C' WHEN 'A' THEN 'F'
         WHEN 'M' THEN 'R' WHEN 'H' THEN 'X' END AS lu
  FROM obs o JOIN customer ON c_custkey = site_id JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey),
train AS (SELECT * FROM named WHERE flag <> 'R' AND y >= 0 AND y < 12.5),
ext AS (SELECT * FROM named WHERE flag = 'R' AND y >= 0 AND lat BETWEEN -90 AND 90 AND lon BETWEEN -180 AND 180)"""

LRR = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
# Names of the vector's elements, in its order.
VECTOR = (
    ["z_mid", "caco3", "bd", "clay_pct", "caco3_gap", "bd_gap"]
    + [f"lrr_{i}" for i in range(5)] + [f"lu_{k}" for k in "CFRX"]
)


@query(
    "M02_preprocessor",
    f"""WITH {OBSERVATIONS}, m AS (SELECT median(caco3) AS caco3, median(bd) AS bd FROM train),
        top AS (SELECT lu AS top FROM train WHERE lu IS NOT NULL GROUP BY lu ORDER BY count(*) DESC, lu LIMIT 1)
        SELECT obs_id, round(z_mid, 6) + 0.0 AS z_mid, round(coalesce(n.caco3, m.caco3), 6) + 0.0 AS caco3,
        round(coalesce(n.bd, m.bd), 6) + 0.0 AS bd, round(clay_pct, 6) + 0.0 AS clay_pct,
        CAST(n.caco3 IS NULL AS INTEGER)::DOUBLE AS caco3_gap, CAST(n.bd IS NULL AS INTEGER)::DOUBLE AS bd_gap, """
    + ", ".join(f"CAST(lrr = '{name}' AS INTEGER)::DOUBLE AS lrr_{i}" for i, name in enumerate(LRR))
    + ", " + ", ".join(f"""CAST(coalesce(lu, top) = '{k}' AS INTEGER)::DOUBLE AS "lu_{k}" """ for k in "CFRX")
    + " FROM named n, m, top",
)
def preprocessor(spark, sf):
    fitted = trained(spark, sf, "soc_pct")["bundle"].point
    rows = observations(spark, sf).withColumn("z_mid", (F.col("top_cm") + F.col("bottom_cm")) / 2)
    vectors = model.feature_matrix(fitted, rows, "obs_id")
    return round_all(
        vectors.select("obs_id", *[F.col("features")[i].alias(name) for i, name in enumerate(VECTOR)])
    )


@query(
    "M03_M05_fit_and_score_external",
    f"""WITH {OBSERVATIONS} SELECT obs_id, round(y, 6) + 0.0 AS observed, TRUE AS predicted FROM ext""",
)
def external_predictions(spark, sf):
    scored = trained(spark, sf, "soc_pct")["external"]
    return round_all(scored.select("obs_id", "observed", (F.col("predicted") >= 0).alias("predicted")))


@query(
    "M04_oof_predictions",
    f"""WITH {OBSERVATIONS}, sizes AS (SELECT site_id, count(*) AS n FROM train GROUP BY site_id),
        dealt AS (SELECT site_id, (row_number() OVER (ORDER BY n DESC, site_id) - 1) % 10 AS turn FROM sizes)
        SELECT obs_id, CAST(CASE WHEN turn < 5 THEN turn + 1 ELSE 10 - turn END AS INTEGER) AS fold,
               round(y, 6) + 0.0 AS observed, TRUE AS predicted FROM train JOIN dealt USING (site_id)""",
)
def oof_predictions(spark, sf):
    oof = trained(spark, sf, "soc_pct")["oof"]
    return round_all(
        oof.select("obs_id", "fold", "observed", (F.col("predicted") >= 0).alias("predicted"))
    )


@query(
    "M06_error_scale",
    f"""WITH {OBSERVATIONS} SELECT obs_id, TRUE AS above_floor, TRUE AS ordered FROM train""",
)
def error_scale(spark, sf):
    bounds = F.col("predicted").between(F.col("lower_90"), F.col("upper_90"))
    return trained(spark, sf, "soc_pct")["oof"].select(
        "obs_id", (F.col("scale") >= TARGETS["soc_pct"].scale_floor).alias("above_floor"),
        (bounds & (F.col("lower_90") >= 0)).alias("ordered"),
    )


KNOWN = model.Boosting(rounds=8, max_depth=3, learning_rate=0.3)


@lru_cache(maxsize=4)
def known_run(spark, sf):
    """A run whose answer is known: carbon is 2 or 8 by clay, with noise below 30 cm alone."""
    clay, deep = F.col("clay_pct") < 30, F.col("top_cm") >= 30
    noise = F.pmod(F.xxhash64("obs_id"), F.lit(1000)) / 1000 - 0.5
    rows = sample(spark, sf).withColumn(
        "SOC_pct", F.when(clay, 2.0).otherwise(8.0) + F.when(deep, 2 * noise).otherwise(0.0)
    )
    train, external = rows.where("l_returnflag <> 'R'"), rows.where("l_returnflag = 'R'")
    return model.train_target(train, external, FEATURES, TARGETS["soc_pct"], KNOWN, KNOWN)


@query(
    "M03_M06_known_split",
    f"""WITH {OBSERVATIONS.split(', train AS')[0]}
        SELECT CASE flag WHEN 'R' THEN 'external' ELSE 'out of fold' END AS part,
               CASE WHEN clay_pct < 30 THEN 2.0::DOUBLE ELSE 8.0::DOUBLE END AS step, z_mid >= 30 AS deep, count(*) AS n,
               TRUE AS predicted_near, TRUE AS scale_right, TRUE AS interval_right FROM named
        WHERE flag <> 'R' OR (lat BETWEEN -90 AND 90 AND lon BETWEEN -180 AND 180) GROUP BY ALL""",
)
def known_split(spark, sf):
    """Nearly all rows of each step and depth must be right. A constant, or a model that learns
    anything else, is wrong for one of the two steps; a constant scale above or below 30 cm."""
    run = known_run(spark, sf)
    steps = sample(spark, sf).select("obs_id", F.when(F.col("clay_pct") < 30, 2.0).otherwise(8.0).alias("step"))
    rows = stack.concat_tagged({
        name: run[key].select("obs_id", "z_mid", "predicted", "scale", "lower_90", "upper_90")
        for name, key in (("out of fold", "oof"), ("external", "external"))
    }, "part").join(steps, "obs_id").withColumn("deep", F.col("z_mid") >= 30)

    def nearly_all(right, name):
        return (F.avg(F.when(right, 1.0).otherwise(0.0)) >= 0.95).alias(name)

    width = F.col("upper_90") - F.col("lower_90")
    return rows.groupBy("part", "step", "deep").agg(
        F.count("*").alias("n"), nearly_all(F.abs(F.col("predicted") - F.col("step")) < 0.6, "predicted_near"),
        nearly_all((F.col("scale") > 0.2) == F.col("deep"), "scale_right"),
        nearly_all((width > 0.7) == F.col("deep"), "interval_right"),
    )


RANK = "CAST(least(n - 1, ceil(least(1.0::DOUBLE, ceil((n + 1) * 0.9::DOUBLE) / n) * (n - 1))) AS BIGINT)"


@query(
    "M07_run_predictions",
    f"""WITH {OBSERVATIONS}, sizes AS (SELECT count(*) AS n FROM train)
        SELECT obs_id, round(y, 6) + 0.0 AS observed, n AS n_scores, {RANK} AS rank, TRUE AS multiplier_at_rank,
               TRUE AS lower_right, TRUE AS upper_right FROM train, sizes""",
)
def run_predictions(spark, sf):
    """The trees' numbers are their own; all that follows from them is worked out again: the
    multiplier is the score of its rank, and the bounds lie that many scales off."""
    run = trained(spark, sf, "soc_pct")
    m = run["manifest"].first()["calibration"]["calibration_multiplier"]
    scored = run["oof"].selectExpr("*", "abs(observed - predicted) / scale AS score")
    n, below, upto = scored.selectExpr(
        "count(score)", f"count_if(score < {m!r}D)", f"count_if(score <= {m!r}D)"
    ).first()
    rank = conformal_rank(n)
    return round_all(scored.select(
        "obs_id", "observed", F.lit(n).cast("bigint").alias("n_scores"), F.lit(rank).cast("bigint").alias("rank"),
        F.lit(below <= rank < upto).alias("multiplier_at_rank"),
        F.expr(f"abs(lower_90 - greatest(0D, predicted - {m!r}D * scale)) < 1e-9D").alias("lower_right"),
        F.expr(f"abs(upper_90 - (predicted + {m!r}D * scale)) < 1e-9D").alias("upper_right"),
    ))


# Rows and pixel means of both evaluations, from the observations alone.
EVALUATED = f"""{OBSERVATIONS.split(', train AS')[0]}, dense AS (SELECT *, 0.6::DOUBLE + y / 10 AS density FROM named),
parts AS (
  SELECT 'grouped {{kind}}' AS part, * FROM dense WHERE flag <> 'R' AND density IS NOT NULL
  UNION ALL SELECT 'external', * FROM dense WHERE flag = 'R' AND density <= 2.0::DOUBLE),
evaluated AS (
  SELECT CASE part WHEN 'external' THEN 'external rows' ELSE part || ' rows' END AS dataset, density AS v FROM parts
  UNION ALL SELECT part || ' pixel x depth', avg(density) FROM parts
  GROUP BY part, {PIXEL_X}, {PIXEL_Y}, CAST(floor(z_mid / 10) AS BIGINT))"""


def recomputed(spark, frames, columns, sql):
    """``sql`` over the run's rows and their pixel means, both told apart by ``dataset``."""
    means = ", ".join(f"avg({c}) AS {c}" for c in columns)
    tables = {}
    for name, rows in frames.items():
        tables[f"{name} rows"] = rows.select(*columns)
        tables[f"{name} pixel x depth"] = spark.sql(
            f"""SELECT {means} FROM {{rows}}
                GROUP BY {PIXEL_X}, {PIXEL_Y}, CAST(floor(z_mid / 10) AS BIGINT)""", rows=rows,
        )
    return spark.sql(sql, evaluated=stack.concat_tagged(tables))


def same(own, again, names):
    """Whether the columns of two tables by ``dataset`` agree."""
    joined = own.join(again.withColumnsRenamed({c: f"again_{c}" for c in names}), "dataset", "full")
    close = [
        (F.abs(F.col(c) - F.col(f"again_{c}")) <= 1e-5 * (1 + F.abs(F.col(c)))).alias(f"{c}_same") for c in names
    ]
    return joined, close


@query(
    "M10_run_metrics",
    f"""WITH {EVALUATED.format(kind='OOF')} SELECT dataset, count(*) AS n, round(avg(v), 6) + 0.0 AS mean_observed,
        TRUE AS r2_same, TRUE AS rmse_same, TRUE AS mae_same, TRUE AS bias_same, TRUE AS mean_predicted_same
        FROM evaluated GROUP BY dataset""",
)
def run_metrics(spark, sf):
    """Metrics of the run next to those worked out again from its predictions."""
    run = trained(spark, sf, "bulk_density")
    names = ["r2", "rmse", "mae", "bias", "mean_predicted"]
    again = recomputed(
        spark, {"grouped OOF": run["oof"], "external": run["external"]}, ["observed", "predicted"],
        """SELECT dataset, 1 - sum(power(predicted - observed, 2)) / (count(*) * var_pop(observed)) AS r2,
                  sqrt(avg(power(predicted - observed, 2))) AS rmse, avg(abs(predicted - observed)) AS mae,
                  avg(predicted - observed) AS bias, avg(predicted) AS mean_predicted
           FROM {evaluated} GROUP BY dataset""",
    )
    joined, close = same(run["metrics"], again, names)
    return round_all(joined.select("dataset", "n", "mean_observed", *close))


@query(
    "M11_run_intervals",
    f"""WITH {EVALUATED.format(kind='cross-fit')} SELECT dataset, count(*) AS n, TRUE AS coverage_90_same,
        TRUE AS mean_interval_width_same, TRUE AS median_interval_width_same, TRUE AS mean_lower_same,
        TRUE AS mean_upper_same FROM evaluated GROUP BY dataset""",
)
def run_intervals(spark, sf):
    """Interval metrics of the run next to those worked out again from its bounds."""
    run = trained(spark, sf, "bulk_density")
    names = ["coverage_90", "mean_interval_width", "median_interval_width", "mean_lower", "mean_upper"]
    again = recomputed(
        spark, {"grouped cross-fit": run["oof"], "external": run["external"]},
        ["observed", "predicted", "lower_90", "upper_90"],
        """SELECT dataset, avg(CASE WHEN observed >= lower_90 AND observed <= upper_90 THEN 1D ELSE 0D END) AS coverage_90,
                  avg(upper_90 - lower_90) AS mean_interval_width, median(upper_90 - lower_90) AS median_interval_width,
                  avg(lower_90) AS mean_lower, avg(upper_90) AS mean_upper FROM {evaluated} GROUP BY dataset""",
    )
    joined, close = same(run["interval_metrics"], again, names)
    return joined.select("dataset", "n", *close)


@query(
    "M10_fold_and_depth_metrics",
    f"""WITH {OBSERVATIONS}, sizes AS (SELECT site_id, count(*) AS n FROM train GROUP BY site_id),
        dealt AS (SELECT site_id, (row_number() OVER (ORDER BY n DESC, site_id) - 1) % 10 AS turn FROM sizes),
        parts AS (SELECT 'fold ' || CASE WHEN turn < 5 THEN turn + 1 ELSE 10 - turn END AS part, y
                  FROM train JOIN dealt USING (site_id)
                  UNION ALL SELECT CASE WHEN z_mid < 30 THEN '0–30 cm' ELSE '>30 cm' END, y FROM train)
        SELECT part, count(*) AS n, round(avg(y), 6) + 0.0 AS mean_observed, TRUE AS right
        FROM parts GROUP BY part HAVING count(*) >= 30 OR part LIKE 'fold%'""",
)
def part_metrics(spark, sf):
    """The run's metrics by fold and by depth group; errors are at least as large as the bias."""
    run = trained(spark, sf, "soc_pct")
    right = ((F.col("rmse") + 1e-9 >= F.col("mae")) & (F.col("mae") + 1e-9 >= F.abs("bias"))).alias("right")
    folds = run["fold_metrics"].withColumn("part", F.concat(F.lit("fold "), F.col("fold")))
    depths = run["depth_metrics"].withColumnRenamed("depth_group", "part")
    return round_all(
        folds.drop("fold").unionByName(depths).select("part", "n", "mean_observed", right)
    )


@query(
    "M11_run_uncertainty_by_depth",
    f"""WITH {OBSERVATIONS}, parts AS (SELECT 'grouped cross-fit rows' AS dataset, z_mid FROM train
          UNION ALL SELECT 'external rows', z_mid FROM ext)
        SELECT dataset, CASE WHEN z_mid < 30 THEN '0–30 cm' ELSE '>30 cm' END AS depth_group, count(*) AS n,
               TRUE AS right FROM parts GROUP BY ALL""",
)
def run_uncertainty_by_depth(spark, sf):
    found = trained(spark, sf, "soc_pct")["uncertainty_by_depth"]
    width = F.abs(F.col("mean_upper") - F.col("mean_lower") - F.col("mean_interval_width")) < 1e-6
    right = (F.col("coverage_90").between(0, 1) & (F.col("mean_lower") >= 0) & width).alias("right")
    return found.select("dataset", "depth_group", "n", right)


@query(
    "M14_write_run",
    f"""WITH {OBSERVATIONS} SELECT (SELECT count(*) FROM train) AS oof, (SELECT count(*) FROM ext) AS external,
        4 AS metrics, 4 AS interval_metrics, 5 AS fold_metrics, 2 AS depth_metrics, 4 AS uncertainty_by_depth,
        4 AS mapping_interval_metrics, 1 AS manifest""",
)
def written_run(spark, sf):
    """Rows of each table of a run, written and read back."""
    path = scratch(spark)
    model.write_run(trained(spark, sf, "soc_pct"), path)
    rows = {name: spark.read.parquet(f"{path}/{name}").agg(F.count("*")) for name in model.OUTPUTS}
    counts = [rows[n].first()[0] for n in model.OUTPUTS]
    wide = {"oof", "external"}
    return spark.range(1).select(*[
        F.lit(c).cast("bigint" if n in wide else "int").alias(n) for n, c in zip(model.OUTPUTS, counts)
    ])


@query(
    "M14_run_manifest",
    f"""WITH {OBSERVATIONS} SELECT 'soc_pct' AS target, '%' AS units, (SELECT count(*) FROM train) AS training_rows,
        (SELECT count(DISTINCT site_id) FROM train) AS training_sites, (SELECT count(*) FROM ext) AS external_rows,
        6 AS n_features, 2 AS n_categorical, 4 AS n_metrics""",
)
def run_manifest(spark, sf):
    manifest = trained(spark, sf, "soc_pct")["manifest"]
    return manifest.select(
        "target", "units", "training_rows", "training_sites", "external_rows",
        F.size("features").alias("n_features"), F.size("categorical_features").alias("n_categorical"),
        F.size("metrics").alias("n_metrics"),
    )


def tiles(spark, sf):
    """Order lines as pixels, with codes for the categories and some nodata."""
    q = F.col("l_quantity")
    return table(spark, sf, "lineitem").select(
        F.concat(F.lit("t"), F.col("l_suppkey") % 4).alias("tile"),
        F.col("l_orderkey").alias("row"), F.col("l_linenumber").alias("col"),
        F.when(q == 50, -9999.0).otherwise(F.col("l_discount") * 100).cast("float").alias("caco3"),
        F.when(q == 49, F.lit(None)).otherwise(0.8 + F.col("l_tax") * 10).cast("float").alias("bd"),
        (F.col("l_partkey") % 60).cast("float").alias("clay_pct"),
        (F.col("l_partkey") % 6 + 1).cast("float").alias("LRR_group"),
        (F.col("l_suppkey") % 4 + 1).cast("float").alias("LU_scraped"),
    )


def lrr_lookup(spark, sf):
    return encode.categories(S.zones(spark, sf), "lrr")


def bundles(spark, sf):
    rows = sample(spark, sf)  # made before both runs ask for it
    return model.side_by_side(
        rows, *[lambda name=name: trained(spark, sf, name)["bundle"] for name in ("soc_pct", "bulk_density")]
    )


TILES = """px AS (
  SELECT 't' || (l_suppkey % 4) AS tile, l_quantity NOT IN (49, 50) AS ok FROM lineitem)"""


def scored_tiles(spark, sf):
    return maps.score_tiles(tiles(spark, sf), bundles(spark, sf), DEPTHS, lrr_lookup(spark, sf))


@query(
    "M12_score_tiles",
    """SELECT 't' || (l_suppkey % 4) AS tile, l_orderkey AS "row", CAST(l_linenumber AS BIGINT) AS col, d AS depth_cm,
       CASE WHEN l_quantity NOT IN (49, 50) THEN 1.0::DOUBLE ELSE -9999.0::DOUBLE END AS valid_data_mask,
       TRUE AS soc_pct_right, TRUE AS bulk_density_right
       FROM lineitem CROSS JOIN (VALUES (5.0::DOUBLE), (30.0::DOUBLE)) v(d)""",
)
def score_tiles(spark, sf):
    """Every pixel at every depth: a prediction between its bounds, or a gap in all bands."""
    scored = scored_tiles(spark, sf)

    def right(name):
        p, low, high, width = (
            F.col(f"{name}_{b}") for b in ("prediction", "lower_90", "upper_90", "interval_width")
        )
        made = (low >= 0) & (low <= p) & (p <= high) & (F.abs(high - low - width) <= 1e-4 * (1 + width))
        gap = (p == NODATA) & (low == NODATA) & (high == NODATA) & (width == NODATA)
        return F.when(F.col("valid_data_mask") == 1, made).otherwise(gap).alias(f"{name}_right")

    return scored.select(
        "tile", F.col("row").cast("bigint").alias("row"), F.col("col").cast("bigint").alias("col"), "depth_cm",
        F.col("valid_data_mask").cast("double").alias("valid_data_mask"), right("soc_pct"), right("bulk_density"),
    )


@query(
    "M12_saved_bundle",
    f"""WITH {TILES} SELECT tile, d AS depth_cm, count(*) AS n_pixels, 0::BIGINT AS n_differ
        FROM px CROSS JOIN (VALUES (5.0::DOUBLE), (30.0::DOUBLE)) v(d) GROUP BY tile, d""",
)
def saved_bundle(spark, sf):
    """Maps by bundles that were written and read back, against those of the run itself."""
    loaded = []
    for bundle in bundles(spark, sf):
        path = scratch(spark)
        model.save_bundle(bundle, path, spark)
        loaded.append(model.load_bundle(spark, path))
    own = scored_tiles(spark, sf)
    again = maps.score_tiles(tiles(spark, sf), loaded, DEPTHS, lrr_lookup(spark, sf))
    sums = [
        df.groupBy("tile", "depth_cm", F.xxhash64(*own.columns).alias("mark")).agg(F.count("*").alias(name))
        for df, name in ((own, "a"), (again, "b"))
    ]
    off = F.abs(F.coalesce("a", F.lit(0)) - F.coalesce("b", F.lit(0)))
    return sums[0].join(sums[1], ["tile", "depth_cm", "mark"], "full").groupBy("tile", "depth_cm").agg(
        F.coalesce(F.sum("b"), F.lit(0)).alias("n_pixels"), F.sum(off).alias("n_differ")
    )


@query(
    "M12_scored_pixels",
    f"""WITH {TILES} SELECT tile, d AS depth_cm, count(*) AS n_pixels, count(*) FILTER (ok) AS n_scored,
        count(*) FILTER (NOT ok) AS n_nodata FROM px CROSS JOIN (VALUES (5.0::DOUBLE), (30.0::DOUBLE)) v(d)
        GROUP BY tile, d""",
)
def scored_pixels(spark, sf):
    scored = scored_tiles(spark, sf)
    bands = [c for c in scored.columns if "_" in c and c not in ("depth_cm", "valid_data_mask")]
    made, gap = F.col("valid_data_mask") == 1, F.col("valid_data_mask") == NODATA
    for band in bands:
        made, gap = made & (F.col(band) >= 0), gap & (F.col(band) == NODATA)
    return scored.groupBy("tile", "depth_cm").agg(
        F.count("*").alias("n_pixels"), F.count_if(made).alias("n_scored"), F.count_if(gap).alias("n_nodata")
    )


@query(
    "M13_run_pending",
    f"""WITH {TILES} SELECT run, tile, d AS depth_cm, count(*) AS n_pixels, count(*) FILTER (ok) AS n_valid
        FROM px CROSS JOIN (VALUES ('first', 5.0::DOUBLE), ('second', 30.0::DOUBLE)) v(run, d) GROUP BY run, tile, d""",
)
def run_pending(spark, sf):
    """Two runs into one folder: the second only does the depth the first left out."""
    path, lookup = scratch(spark), lrr_lookup(spark, sf)
    pixels, both = tiles(spark, sf), bundles(spark, sf)
    first = maps.run_pending(pixels, both, path, DEPTHS[:1], lookup)
    second = maps.run_pending(pixels, both, path, DEPTHS, lookup)
    return stack.concat_tagged({"first": first, "second": second}, "run").select(
        "run", "tile", "depth_cm", "n_pixels", "n_valid"
    )


PUBLISHED = "tile STRING, depth_cm DOUBLE, row BIGINT, col BIGINT, valid_data_mask FLOAT"


@query(
    "M13s_stream_tiles",
    f"""WITH {TILES} SELECT tile, d AS depth_cm, count(*) AS n_pixels, count(*) FILTER (ok) AS n_valid
        FROM px CROSS JOIN (VALUES {", ".join(f"({d}::DOUBLE)" for d in DEPTHS_CM)}) v(d) GROUP BY tile, d""",
)
def stream_tiles(spark, sf):
    """The same job as a file stream over tile files, at all depths."""
    source, out, state = scratch(spark), scratch(spark), scratch(spark)
    pixels = tiles(spark, sf)
    pixels.write.parquet(source)
    stream = tile_stream(spark, source, pixels.schema)
    score_new_tiles(stream, bundles(spark, sf), out, state, DEPTHS_CM, lrr_lookup(spark, sf)).awaitTermination()
    maps_ = snapshots.read_snapshot(spark, out, PUBLISHED)
    return maps_.groupBy("tile", "depth_cm").agg(
        F.count("*").alias("n_pixels"), F.count_if(F.col("valid_data_mask") == 1).alias("n_valid")
    )
