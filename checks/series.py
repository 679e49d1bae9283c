"""Window joins, window statistics, harmonic fits and composites over image series."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from checks import standins as S
from checks.registry import query, round_all, table
from loamline.functions import physical
from loamline.operators import composite, harmonic, stack
from loamline.operators.blocks import Stat, distinct_targets, image_counts, in_time_range, window_stats
from loamline.operators.window_join import window_join, window_quantiles, window_quartiles
from loamline.operators.zones import asof_values, sample_cells
from loamline.plans.covariates import array_cv, fire_frequency

# Window bounds as the oracle computes them.
BOUNDS = {
    "1y": ("cutoff - INTERVAL 1 YEAR", "cutoff"),
    "5y": ("cutoff - INTERVAL 5 YEAR", "cutoff"),
    "10y": ("cutoff - INTERVAL 10 YEAR", "cutoff"),
    "clim10": ("make_date(year(cutoff) - 10, 1, 1)", "make_date(year(cutoff), 1, 1)"),
    "spring": (
        "make_date(year(cutoff) - CASE WHEN month(cutoff) >= 6 THEN 0 ELSE 1 END, 3, 1)",
        "make_date(year(cutoff) - CASE WHEN month(cutoff) >= 6 THEN 0 ELSE 1 END, 6, 1)",
    ),
}


def in_bounds(window: str) -> str:
    start, end = BOUNDS[window]
    return f"ts >= {start} AND ts < {end}"


def paired(window: str, name: str = "p", source: str = "masked") -> str:
    """CTE of targets with the observations of their cell in a window."""
    return f"""{name} AS (SELECT t.cell_id, t.cutoff, s.* EXCLUDE (cell_id) FROM targets t
      LEFT JOIN {source} s ON s.cell_id = t.cell_id AND {in_bounds(window)})"""


DAY = "strftime(cutoff, '%Y-%m-%d') AS cutoff"
BASE = f"{S.MASKED}, {S.POINTS}"


def inputs(spark, sf):
    points = S.points(spark, sf)
    return S.masked(S.series(spark, sf)), points, distinct_targets(points)


def flagship(spark, sf):
    """Mean, quartiles and IQR of the masked values in the year before each point's cutoff."""
    series, points, targets = inputs(spark, sf)
    stats = window_quartiles(
        series, targets, "1y", ["v"], [Stat("v_n", "v", "count", "1y")]
    )
    return round_all(
        points.select("point_id", "cell_id", "cutoff").join(stats, ["cell_id", "cutoff"], "left")
    )


query(
    "A09_A10_window_quartiles",
    f"""WITH {BASE}, {paired('1y')}, w AS (
          SELECT cell_id, cutoff, count(v) AS v_n, avg(v) AS v_mean, quantile_cont(v, 0.25) AS v_p25,
                 quantile_cont(v, 0.75) AS v_p75 FROM p GROUP BY cell_id, cutoff)
        SELECT point_id, cell_id, {DAY}, v_n, round(v_mean, 6) + 0.0 AS v_mean, round(v_p25, 6) + 0.0 AS v_p25,
               round(v_p75, 6) + 0.0 AS v_p75, round(v_p75 - v_p25, 6) + 0.0 AS "v_IQR"
        FROM points JOIN w USING (cell_id, cutoff)""",
)(flagship)


@query(
    "J05_window_join",
    f"""WITH {BASE} SELECT point_id, strftime(ts, '%Y-%m-%d') AS day, round(v, 6) + 0.0 AS v
        FROM points JOIN masked ON masked.cell_id = points.cell_id AND {in_bounds('1y')}""",
)
def join_window(spark, sf):
    series, points, targets = inputs(spark, sf)
    joined = window_join(
        points.select("point_id", "cell_id", "cutoff").join(targets.keys(["1y"]), ["cell_id", "cutoff"]),
        series.select("cell_id", "ts", "v"), "1y",
    )
    return round_all(joined.select("point_id", F.col("ts").cast("date").alias("day"), "v"))


@query(
    "A09_A11_A12_window_stats",
    f"""WITH {BASE}, wide AS (SELECT *, CASE WHEN (tmin + tmax) / 2 > 5 THEN v END AS warm FROM masked)
        SELECT t.cell_id, {DAY.replace('cutoff,', 't.cutoff,')},
        round(sum(v) FILTER ({in_bounds('1y')}), 6) + 0.0 AS v_sum,
        round(avg(v) FILTER ({in_bounds('5y')}), 6) + 0.0 AS v_mean_5y,
        round(min(tmin) FILTER ({in_bounds('spring')}), 6) + 0.0 AS tmin_spring,
        round(max(v) FILTER ({in_bounds('clim10')}), 6) + 0.0 AS v_max_clim,
        count(v) FILTER ({in_bounds('1y')}) AS v_n,
        round(avg(warm) FILTER ({in_bounds('clim10')}), 6) + 0.0 AS warm_mean,
        round(sum(prcp) FILTER ({in_bounds('clim10')}), 6) + 0.0 AS total_10y,
        round(sum(prcp) FILTER ({in_bounds('clim10')}) / 10, 6) + 0.0 AS annual_mean
        FROM targets t LEFT JOIN wide s ON s.cell_id = t.cell_id GROUP BY t.cell_id, t.cutoff""",
)
def stats_of_windows(spark, sf):
    series, points, targets = inputs(spark, sf)
    tmean = physical.mean_temperature(F.col("tmin"), F.col("tmax"))
    wide = series.withColumn("warm", F.when(tmean > 5, F.col("v")))
    result = window_stats(
        wide, targets,
        [
            Stat("v_sum", "v", "sum", "1y"), Stat("v_mean_5y", "v", "mean", "5y"),
            Stat("tmin_spring", "tmin", "min", "spring"), Stat("v_max_clim", "v", "max", "clim10"),
            Stat("v_n", "v", "count", "1y"), Stat("warm_mean", "warm", "mean", "clim10"),
            Stat("total_10y", "prcp", "sum", "clim10"),
        ],
    )
    return round_all(result.withColumn("annual_mean", F.col("total_10y") / 10))


@query(
    "A13_annual_cv",
    f"""WITH {BASE}, {paired('clim10')}, years AS (
          SELECT cell_id, cutoff, year(ts) AS y, sum(prcp) AS total FROM p GROUP BY cell_id, cutoff, year(ts))
        SELECT cell_id, {DAY}, round(stddev_pop(total) / avg(total), 6) + 0.0 AS cv
        FROM years GROUP BY cell_id, cutoff""",
)
def annual_cv(spark, sf):
    series, points, targets = inputs(spark, sf)
    years = window_stats(
        series, targets, [Stat("y", "prcp", "sum", "clim10", by="year")]
    )
    return round_all(years.select("cell_id", "cutoff", array_cv(F.col("y")).alias("cv")))


MONTHS = f"""{BASE}, {paired('clim10')}, months AS (
  SELECT cell_id, cutoff, CAST(month(ts) AS INTEGER) AS month, avg(v) AS m FROM p
  WHERE ts IS NOT NULL GROUP BY cell_id, cutoff, month(ts))"""


@query(
    "A14_monthly_climatology",
    f"WITH {MONTHS} SELECT cell_id, {DAY}, month, round(m, 6) + 0.0 AS m FROM months WHERE m IS NOT NULL",
)
def monthly_climatology(spark, sf):
    series, points, targets = inputs(spark, sf)
    months = window_stats(
        series, targets, [Stat("m", "v", "mean", "clim10", by="month")]
    )
    long = months.select("cell_id", "cutoff", F.posexplode("m").alias("at", "m"))
    return round_all(
        long.where(F.col("m").isNotNull()).select(
            "cell_id", "cutoff", (F.col("at") + 1).alias("month"), "m"
        )
    )


TWO_PI = f"{2 * math.pi!r}::DOUBLE"


def least_squares(source: str) -> str:
    """CTEs that fit y on the harmonic basis of t by modified Gram-Schmidt, one regressor
    after the other: an independent route to the same coefficients."""
    basis = [
        "1.0::DOUBLE", f"cos({TWO_PI} * t)", f"sin({TWO_PI} * t)", f"cos(2 * {TWO_PI} * t)",
        f"sin(2 * {TWO_PI} * t)", "t",
    ]
    ctes = [
        "q0 AS (SELECT cell_id, cutoff, y, "
        + ", ".join(f"{b} AS x{i}" for i, b in enumerate(basis))
        + f" FROM {source} WHERE y IS NOT NULL)"
    ]
    for k in range(6):
        shares = [f"sum(x{k} * x{j}) / nullif(sum(x{k} * x{k}), 0) AS r{k}{j}" for j in range(k + 1, 6)]
        shares.append(f"sum(x{k} * y) / nullif(sum(x{k} * x{k}), 0) AS z{k}")
        ctes.append(f"g{k} AS (SELECT cell_id, cutoff, {', '.join(shares)} FROM q{k} GROUP BY cell_id, cutoff)")
        rest = [f"x{j} - r{k}{j} * x{k} AS x{j}" for j in range(k + 1, 6)]
        ctes.append(
            f"q{k + 1} AS (SELECT cell_id, cutoff, {', '.join([*rest, f'y - z{k} * x{k} AS y'])} "
            f"FROM q{k} JOIN g{k} USING (cell_id, cutoff))"
        )
    inner = "SELECT *, z5 AS c5 FROM g0 " + " ".join(f"JOIN g{k} USING (cell_id, cutoff)" for k in range(1, 6))
    for k in range(4, -1, -1):
        terms = " ".join(f"- r{k}{j} * c{j}" for j in range(k + 1, 6))
        inner = f"SELECT *, z{k} {terms} AS c{k} FROM ({inner})"
    ctes.append(f"fit AS ({inner})")
    return ", ".join(ctes)


def polar_sql(suffix: str = "") -> str:
    names = [("beta0", "c0"), ("a1", "c1"), ("b1", "c2"), ("a2", "c3"), ("b2", "c4"), ("trend", "c5")]
    parts = [f"round({c}, 4) + 0.0 AS v_{n}{suffix}" for n, c in names]
    for order, (a, b) in enumerate((("c1", "c2"), ("c3", "c4")), 1):
        parts.append(f"round(sqrt({a} * {a} + {b} * {b}), 4) + 0.0 AS v_amp{order}{suffix}")
        parts.append(f"round(atan2(-{b}, {a}), 4) + 0.0 AS v_phase{order}{suffix}")
    return ", ".join(parts)


YEARS = (
    "date_diff('day', CAST(cutoff - INTERVAL 10 YEAR AS DATE), CAST(ts AS DATE)) / 365.25::DOUBLE"
)


@query(
    "A15_A17_harmonic_fit",
    f"""WITH {BASE}, {paired('10y')}, rows_ AS (SELECT cell_id, cutoff, {YEARS} AS t, v AS y FROM p),
        {least_squares('rows_')} SELECT cell_id, {DAY}, {polar_sql()} FROM fit""",
)
def harmonic_fit(spark, sf):
    series, points, targets = inputs(spark, sf)
    fitted = harmonic.harmonic_fit(series, targets, "10y", {"v": "v"})
    return round_all(fitted, 4)


@query(
    "A16_A17_harmonic_monthly",
    f"""WITH {MONTHS}, rows_ AS (SELECT cell_id, cutoff, (month - 0.5::DOUBLE) / 12 AS t, m AS y FROM months),
        {least_squares('rows_')} SELECT cell_id, {DAY}, {polar_sql('_10y')},
        round(c5, 4) + 0.0 AS v_tcoef_10y FROM fit""",
)
def harmonic_monthly(spark, sf):
    series, points, targets = inputs(spark, sf)
    months = window_stats(
        series, targets, [Stat("m", "v", "mean", "clim10", by="month")]
    )
    return round_all(harmonic.harmonic_fit_monthly(months, "m", "v", "_10y").drop("m"), 4)


@query(
    "A15_image_counts",
    f"""WITH {BASE}, images AS (SELECT DISTINCT ts FROM series), cutoffs AS (SELECT DISTINCT cutoff FROM targets)
        SELECT {DAY}, count(ts) FILTER ({in_bounds('10y')}) AS n_images_10y,
               count(ts) FILTER ({in_bounds('1y')}) AS n_images_1y
        FROM cutoffs CROSS JOIN images GROUP BY cutoff""",
)
def count_images(spark, sf):
    series, points, targets = inputs(spark, sf)
    parts = [
        image_counts(in_time_range(series.select("ts"), targets, [w]).distinct(), targets, w)
        .withColumnRenamed("n_images", f"n_images_{w}")
        for w in ("10y", "1y")
    ]
    return round_all(parts[0].join(parts[1], "cutoff"))


@query(
    "A18_fire_frequency",
    f"""WITH {BASE}, {paired('5y')}, years AS (
          SELECT cell_id, cutoff, year(ts) AS y, max(CASE WHEN v > 100 THEN 1 WHEN v IS NOT NULL THEN 0 END) AS burned
          FROM p GROUP BY cell_id, cutoff, year(ts))
        SELECT cell_id, {DAY}, round(sum(burned) / 6.0::DOUBLE, 6) + 0.0 AS fire_freq_win
        FROM years GROUP BY cell_id, cutoff""",
)
def fires(spark, sf):
    series, _, targets = inputs(spark, sf)
    burn = series.select(
        "cell_id", "ts", F.when(F.col("v") > 100, 10).when(F.col("v").isNotNull(), 0).alias("burn_date")
    )
    return round_all(fire_frequency(burn, targets))


# --- as-of, sampling, stacking ---------------------------------------------------------

RELEASES = [1996, 1997, 1998, 1999]


@query(
    "J06_asof_release",
    f"""WITH {S.POINTS}, cover AS (
          SELECT l_suppkey AS cell_id, CAST(year(l_shipdate) AS INTEGER) AS release_year, max(l_partkey) AS landcover
          FROM lineitem GROUP BY ALL),
        chosen AS (SELECT *, (SELECT max(r) FROM (VALUES (1996), (1997), (1998), (1999)) v(r)
                              WHERE r <= year(cutoff)) AS release_year FROM points)
        SELECT point_id, CAST(release_year AS INTEGER) AS release_year, landcover
        FROM chosen LEFT JOIN cover USING (cell_id, release_year)""",
)
def asof_release(spark, sf):
    cover = (
        table(spark, sf, "lineitem")
        .groupBy(F.col("l_suppkey").alias("cell_id"), F.year("l_shipdate").alias("release_year"))
        .agg(F.max("l_partkey").alias("landcover"))
    )
    found = asof_values(S.points(spark, sf), cover, RELEASES)
    return found.select("point_id", "release_year", "landcover")


@query(
    "J07_sample_cells",
    f"""WITH {S.POINTS}, cells AS (SELECT s_suppkey AS cell_id, s_acctbal AS elv FROM supplier WHERE s_acctbal > 0)
        SELECT point_id, coalesce(round(elv, 6) + 0.0, -9999.0::DOUBLE) AS elv FROM points LEFT JOIN cells USING (cell_id)""",
)
def sample(spark, sf):
    cells = table(spark, sf, "supplier").where("s_acctbal > 0").selectExpr(
        "s_suppkey AS cell_id", "s_acctbal AS elv"
    )
    return round_all(sample_cells(S.points(spark, sf), cells, -9999.0).select("point_id", "elv"))


@query(
    "J09_stack",
    f"""WITH {BASE}, a AS (SELECT cell_id, max(v) AS vmax FROM masked GROUP BY cell_id),
        b AS (SELECT s_suppkey AS cell_id, s_nationkey AS zone FROM supplier WHERE s_acctbal > 0)
        SELECT s_suppkey AS cell_id, round(vmax, 6) + 0.0 AS vmax, zone FROM supplier
        LEFT JOIN a ON a.cell_id = s_suppkey LEFT JOIN b ON b.cell_id = s_suppkey""",
)
def stacked(spark, sf):
    series, _, _ = inputs(spark, sf)
    supplier = table(spark, sf, "supplier")
    parts = [
        series.groupBy("cell_id").agg(F.max("v").alias("vmax")),
        supplier.where("s_acctbal > 0").selectExpr("s_suppkey AS cell_id", "s_nationkey AS zone"),
    ]
    return round_all(stack.stack(supplier.selectExpr("s_suppkey AS cell_id"), parts, ["cell_id"]))


# --- composites ------------------------------------------------------------------------

SENSOR = "CASE vec_id % 4 WHEN 0 THEN 'LT04' WHEN 1 THEN 'LT05' WHEN 2 THEN 'LE07' ELSE 'LC08' END"


@query(
    "P27_U02_harmonise_sensors",
    f"""WITH raw AS (SELECT vec_id, label::BIGINT AS cell_id, {SENSOR} AS sensor, """
    + ", ".join(f"CAST(round(embedding[{i}]::DOUBLE * 10000) AS INTEGER) + 20000 AS sr_b{i}" for i in range(1, 8))
    + """ FROM embeddings), named AS (
        SELECT vec_id, cell_id, sensor, CASE WHEN sensor = 'LC08' THEN sr_b2 ELSE sr_b1 END AS blue,
               CASE WHEN sensor = 'LC08' THEN sr_b5 ELSE sr_b4 END AS nir, sr_b7 AS swir2 FROM raw)
        SELECT cell_id, sensor, vec_id AS pixel_qa, round(blue * 0.0000275::DOUBLE - 0.2::DOUBLE, 9) + 0.0 AS blue,
               round(nir * 0.0000275::DOUBLE - 0.2::DOUBLE, 9) + 0.0 AS nir,
               round(swir2 * 0.0000275::DOUBLE - 0.2::DOUBLE, 9) + 0.0 AS swir2 FROM named""",
)
def harmonise_sensors(spark, sf):
    raw = table(spark, sf, "embeddings").select(
        F.col("label").cast("bigint").alias("cell_id"), F.lit(None).cast("timestamp_ntz").alias("ts"),
        F.expr(SENSOR).alias("sensor"), F.col("vec_id").alias("qa_pixel"),
        *[
            (F.round(F.get("embedding", F.lit(i - 1)).cast("double") * 10000).cast("int") + 20000).alias(f"sr_b{i}")
            for i in range(1, 8)
        ],
    )
    early = [
        composite.harmonise_bands(raw.where(F.col("sensor") == s), s) for s in composite.EARLY_SENSORS
    ]
    late = composite.harmonise_mixed(raw.where(F.col("sensor") == "LC08"))
    return round_all(composite.merge_sensors([*early, late]).select("cell_id", "sensor", "pixel_qa", "blue", "nir", "swir2"), 9)


SOIL_TARGETS = """soil_targets AS (
  SELECT DISTINCT label::BIGINT AS cell_id, DATE '2000-07-01' + CAST(vec_id % 3 * 100 AS INTEGER) AS cutoff
  FROM embeddings)"""


@query(
    "A19_A20_bare_soil",
    f"""WITH {S.FLAGGED}, {SOIL_TARGETS}, p AS (
          SELECT t.cell_id, t.cutoff, f.* EXCLUDE (cell_id) FROM soil_targets t
          LEFT JOIN flagged f ON f.cell_id = t.cell_id AND {in_bounds('1y')})
        SELECT cell_id, {DAY}, """
    + ", ".join(
        f"round(CASE WHEN cell_id <> 3 THEN median({b}) FILTER (is_soil) END, 6) + 0.0 AS {b}_median"
        for b in ("blue", "green", "red", "nir", "swir1", "swir2")
    )
    + """, round(CASE WHEN cell_id <> 3 THEN CAST(sum(CAST(is_soil AS INTEGER)) AS DOUBLE)
             / nullif(count(*) FILTER (clear), 0) END, 6) + 0.0 AS "SF_median"
        FROM p GROUP BY cell_id, cutoff""",
)
def bare_soil(spark, sf):
    flagged = composite.soil_flags(S.bands(spark, sf))
    targets = table(spark, sf, "embeddings").select(
        F.col("label").cast("bigint").alias("cell_id"),
        F.date_add(F.lit("2000-07-01").cast("date"), (F.col("vec_id") % 3 * 100).cast("int")).alias("cutoff"),
    )
    land = targets.select("cell_id").distinct().withColumn("on_land", F.col("cell_id") != 3)
    return round_all(
        composite.bare_soil(flagged, distinct_targets(targets), "1y", land)
    )


@query(
    "U03_mosaic",
    """SELECT l_suppkey AS cell_id, arg_max(l_partkey, l_orderkey * 10 + l_linenumber) AS mukey
       FROM (SELECT l_suppkey, l_orderkey, l_linenumber, max(l_partkey) AS l_partkey FROM lineitem
             WHERE l_tax > 0.02::DOUBLE GROUP BY ALL) GROUP BY l_suppkey""",
)
def mosaic(spark, sf):
    rows = (
        table(spark, sf, "lineitem")
        .groupBy("l_suppkey", "l_orderkey", "l_linenumber")
        .agg(F.max(F.when(F.col("l_tax") > 0.02, F.col("l_partkey"))).alias("mukey"))
        .withColumn("priority", F.col("l_orderkey") * 10 + F.col("l_linenumber"))
        .withColumnRenamed("l_suppkey", "cell_id")
    )
    return composite.mosaic(rows, "cell_id", "mukey", "priority")


HOT = "CASE WHEN {0} % 3 = 0 THEN 0 ELSE {0} END"


@query(
    "A10_hot_cell_quartiles",
    f"""WITH {S.SERIES}, {S.POINTS},
        hot_series AS (SELECT {HOT.format('cell_id')} AS cell_id, ts, v FROM series),
        hot_targets AS (SELECT DISTINCT {HOT.format('cell_id')} AS cell_id, cutoff FROM points),
        p AS (SELECT t.cell_id, t.cutoff, s.v FROM hot_targets t
              JOIN hot_series s ON s.cell_id = t.cell_id AND {in_bounds('1y')})
        SELECT cell_id, {DAY}, round(quantile_cont(v, 0.25), 6) + 0.0 AS p25,
               round(quantile_cont(v, 0.75), 6) + 0.0 AS p75 FROM p GROUP BY cell_id, cutoff""",
)
def hot_cell_quartiles(spark, sf):
    """A third of all observations in one cell: the bucketed path for it, pairs for the rest."""
    merged = F.expr(HOT.format("cell_id"))
    series = S.series(spark, sf).withColumn("cell_id", merged)
    targets = distinct_targets(S.points(spark, sf).withColumn("cell_id", merged))
    found = window_quantiles(
        series.select("cell_id", "ts", "v"), targets, "1y", ["v"], (0.25, 0.75), hot_rows=1000
    )
    return round_all(
        found.select("cell_id", "cutoff", F.col("v")[0].alias("p25"), F.col("v")[1].alias("p75"))
    )
