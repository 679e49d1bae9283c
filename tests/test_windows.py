import datetime as dt
import math
import re
import threading
import time
from collections import defaultdict

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from loamline.functions.windows import cutoff_windows
from loamline.operators import blocks, harmonic
from loamline.operators.blocks import Stat, distinct_targets, window_stats
from loamline.operators.composite import bare_soil, soil_flags
from loamline.operators.window_join import window_join, window_quantiles, window_quartiles
from loamline.plans import covariates
from loamline.plans.covariates import array_cv, evapotranspiration, fire_frequency, series_family


def day(text):
    return dt.datetime.fromisoformat(text)


@pytest.fixture(scope="module")
def data(spark):
    """Daily-ish observations of five cells over twelve years, one far larger than the others."""
    rng = np.random.default_rng(7)
    start = day("2000-01-01")
    rows = []
    for cell, n in ((1, 900), (2, 700), (3, 40), (4, 5000), (5, 1)):
        days = rng.integers(0, 4400, n)
        values = np.round(rng.normal(10, 5, n), 1)
        rows += [
            (cell, start + dt.timedelta(days=int(d)), None if rng.random() < 0.1 else float(v))
            for d, v in zip(days, values)
        ]
    cutoffs = ["2010-06-01", "2010-05-31", "2012-02-29", "2011-01-01", "2009-03-17", "1999-01-01"]
    points = [(c, day(t).date()) for c in (1, 2, 3, 4, 5, 6) for t in cutoffs]
    series = spark.createDataFrame(rows, "cell_id BIGINT, ts TIMESTAMP_NTZ, v DOUBLE").cache()
    frame = spark.createDataFrame(points, "cell_id BIGINT, cutoff DATE")
    pandas = pd.DataFrame(rows, columns=["cell_id", "ts", "v"])
    pandas["v"] = pandas["v"].astype(float)
    return series, distinct_targets(frame), pandas, points


def back(date, years):
    try:
        return date.replace(year=date.year - years)
    except ValueError:
        return date.replace(year=date.year - years, day=28)


def bounds(window, cutoff):
    if window == "clim10":
        return dt.date(cutoff.year - 10, 1, 1), dt.date(cutoff.year, 1, 1)
    if window == "spring":
        year = cutoff.year if cutoff >= dt.date(cutoff.year, 6, 1) else cutoff.year - 1
        return dt.date(year, 3, 1), dt.date(year, 6, 1)
    return back(cutoff, int(window[:-1])), cutoff


def inside(pandas, cell, cutoff, window):
    low, high = (pd.Timestamp(b) for b in bounds(window, cutoff))
    rows = pandas[(pandas.cell_id == cell) & (pandas.ts >= low) & (pandas.ts < high)]
    return rows


WINDOWS = ["1y", "5y", "10y", "clim10", "spring"]


@pytest.mark.parametrize("limit", [2_000_000, 0])
def test_block_statistics_equal_brute_force(data, monkeypatch, limit):
    monkeypatch.setattr(blocks, "CELL_ROWS", limit)
    series, targets, pandas, points = data
    stats = [Stat(f"{fn}_{w}", "v", fn, w) for w in WINDOWS for fn in ("sum", "count", "mean", "min", "max")]
    got = {(r["cell_id"], r["cutoff"]): r for r in window_stats(series, targets, stats).collect()}
    assert set(got) == set(points)
    for (cell, cutoff), row in got.items():
        for w in WINDOWS:
            values = inside(pandas, cell, cutoff, w).v.dropna()
            assert row[f"count_{w}"] == len(values)
            for fn in ("sum", "mean", "min", "max"):
                if len(values):
                    assert row[f"{fn}_{w}"] == pytest.approx(getattr(values, fn)())
                else:
                    assert row[f"{fn}_{w}"] is None


def test_cells_of_many_targets_are_not_broadcast(spark):
    """What is broadcast lies on the driver, once for each dataset that runs."""
    points = spark.range(101_000).selectExpr("id AS cell_id", "DATE'2010-06-15' AS cutoff")
    series = spark.createDataFrame([(1, day("2010-05-31"), 1.0)], "cell_id BIGINT, ts TIMESTAMP_NTZ, v DOUBLE")
    plan = window_stats(series, distinct_targets(points), [Stat("s", "v", "sum", "1y")])._jdf.queryExecution()
    assert "strategy=broadcast" not in plan.analyzed().toString()


def test_few_datasets_run_at_once(spark, monkeypatch):
    """The driver holds the plans of those that run."""
    running, most, lock = [0], [0], threading.Lock()

    def slow(df):
        with lock:
            running[0] += 1
            most[0] = max(most[0], running[0])
        time.sleep(0.3)
        with lock:
            running[0] -= 1
        return df

    points = spark.createDataFrame([(1, 1.0, 1.0, 1, dt.date(2010, 6, 1))], "point_id BIGINT, lat DOUBLE, lon DOUBLE, cell_id BIGINT, cutoff DATE")
    data = defaultdict(lambda: None)
    part = lambda *_, **__: points.select("cell_id", "cutoff")
    for name in ("land_cover_family", "series_family", "climate_family", "fire_frequency", "window_stats", "bare_soil_family",
                 "vegetation", "water_index", "evapotranspiration", "daily_climate", "reanalysis"):
        monkeypatch.setattr(covariates, name, part)
    monkeypatch.setattr(covariates, "stored", slow)
    monkeypatch.setattr(covariates, "zone_family", lambda *_: (points.select("point_id"), None))
    monkeypatch.setattr(covariates, "static_family", lambda *_: points.select("cell_id").distinct())
    covariates.point_covariates(points, data)
    assert 1 < most[0] <= 3


def test_nothing_on_or_after_the_cutoff(spark):
    rows = [(1, day("2010-05-31"), 1.0), (1, day("2010-06-01"), 99.0), (1, day("2009-06-01"), 2.0), (1, day("2009-05-31"), 99.0)]
    series = spark.createDataFrame(rows, "cell_id BIGINT, ts TIMESTAMP_NTZ, v DOUBLE")
    targets = distinct_targets(spark.createDataFrame([(1, dt.date(2010, 6, 1))], "cell_id BIGINT, cutoff DATE"))
    row = window_stats(series, targets, [Stat("s", "v", "sum", "1y")]).first()
    assert row["s"] == 3.0
    assert sorted(r["v"] for r in window_join(targets.keys(["1y"]), series, "1y").collect()) == [1.0, 2.0]


@pytest.mark.parametrize("hot_rows", [1_000_000, 500, 10])
def test_quartiles_equal_brute_force(data, hot_rows):
    series, targets, pandas, points = data
    got = window_quantiles(series, targets, "1y", ["v"], (0.0, 0.25, 0.5, 0.75, 1.0), hot_rows)
    found = {(r["cell_id"], r["cutoff"]): r["v"] for r in got.collect()}
    for cell, cutoff in points:
        values = inside(pandas, cell, cutoff, "1y").v.dropna()
        levels = found.get((cell, cutoff))
        if len(values):
            assert levels == pytest.approx(list(np.quantile(values, (0, 0.25, 0.5, 0.75, 1))))
        else:
            assert levels is None or levels[0] is None


def test_quartile_columns(data):
    series, targets, pandas, points = data
    row = window_quartiles(series, targets, "1y", ["v"]).where("cell_id = 1 AND cutoff = '2010-06-01'").first()
    values = inside(pandas, 1, dt.date(2010, 6, 1), "1y").v.dropna()
    assert row["v_mean"] == pytest.approx(values.mean())
    assert row["v_IQR"] == pytest.approx(np.quantile(values, 0.75) - np.quantile(values, 0.25))


def test_by_year_and_month(data):
    series, targets, pandas, _ = data
    got = window_stats(
        series, targets,
        [Stat("y", "v", "sum", "clim10", by="year"), Stat("m", "v", "mean", "clim10", by="month")],
    ).withColumn("cv", array_cv(F.col("y"))).where("cell_id = 2 AND cutoff = '2011-01-01'").first()
    values = inside(pandas, 2, dt.date(2011, 1, 1), "clim10").dropna()
    totals = values.groupby(values.ts.dt.year).v.sum()
    means = values.groupby(values.ts.dt.month).v.mean()
    assert got["y"] == pytest.approx([totals.get(y) for y in range(2001, 2011)])
    assert got["m"] == pytest.approx([means.get(m) for m in range(1, 13)])
    assert got["cv"] == pytest.approx(totals.std(ddof=0) / totals.mean())


def design(t):
    w = 2 * math.pi
    return np.column_stack([np.ones_like(t), np.cos(w * t), np.sin(w * t), np.cos(2 * w * t), np.sin(2 * w * t), t])


def test_harmonic_fit_equals_least_squares(data):
    series, targets, pandas, _ = data
    got = harmonic.harmonic_fit(series, targets, "10y", {"v": "v"}).where("cell_id = 1 AND cutoff = '2010-05-31'").first()
    rows = inside(pandas, 1, dt.date(2010, 5, 31), "10y").dropna()
    t = (rows.ts - pd.Timestamp("2000-05-31")).dt.total_seconds().to_numpy() / 86400 / 365.25
    beta = np.linalg.lstsq(design(t), rows.v.to_numpy(), rcond=None)[0]
    assert [got[f"v_{c}"] for c in harmonic.COEFFICIENTS] == pytest.approx(list(beta), abs=1e-9)
    assert got["v_amp1"] == pytest.approx(math.hypot(beta[1], beta[2]))
    assert got["v_phase2"] == pytest.approx(math.atan2(-beta[4], beta[3]))


def test_harmonic_fit_recovers_a_signal_with_time_of_day(spark):
    beta = np.array([3.0, -1.5, 0.7, 0.2, -0.4, 0.05])
    start = pd.Timestamp("2000-06-01")
    stamps = [start + pd.Timedelta(hours=37 * i) for i in range(2300)]
    t = np.array([(s - start).total_seconds() for s in stamps]) / 86400 / 365.25
    rows = [(1, s.to_pydatetime(), float(v)) for s, v in zip(stamps, design(t) @ beta)]
    series = spark.createDataFrame(rows, "cell_id BIGINT, ts TIMESTAMP_NTZ, v DOUBLE")
    targets = distinct_targets(spark.createDataFrame([(1, dt.date(2010, 6, 1))], "cell_id BIGINT, cutoff DATE"))
    got = harmonic.harmonic_fit(series, targets, "10y", {"v": "v"}).first()
    assert [got[f"v_{c}"] for c in harmonic.COEFFICIENTS] == pytest.approx(list(beta), abs=1e-8)


@pytest.mark.parametrize("images, fitted", [(9, False), (10, True)])
def test_harmonic_guard_counts_images_of_the_dataset(spark, images, fitted):
    stamps = [day("2005-01-01") + dt.timedelta(days=131 * i) for i in range(images)]
    rows = [(1, s, float(i % 4)) for i, s in enumerate(stamps)]
    series = spark.createDataFrame(rows, "cell_id BIGINT, ts TIMESTAMP_NTZ, v DOUBLE")
    targets = distinct_targets(spark.createDataFrame([(1, dt.date(2010, 6, 1))], "cell_id BIGINT, cutoff DATE"))
    got = harmonic.harmonic_fit(series, targets, "10y", {"v": "v"}).first()
    assert (got["v_beta0"] is not None) == fitted


def test_harmonic_fit_of_too_few_values_is_null(spark):
    """Twelve images in the dataset, but only four values in this cell."""
    stamps = [day("2005-01-01") + dt.timedelta(days=131 * i) for i in range(12)]
    rows = [(2, s, 1.0) for s in stamps] + [(1, s, float(i)) for i, s in enumerate(stamps[:4])]
    series = spark.createDataFrame(rows, "cell_id BIGINT, ts TIMESTAMP_NTZ, v DOUBLE")
    targets = distinct_targets(spark.createDataFrame([(1, dt.date(2010, 6, 1))], "cell_id BIGINT, cutoff DATE"))
    got = harmonic.harmonic_fit(series, targets, "10y", {"v": "v"}).first()
    assert got["v_beta0"] is None and got["v_amp1"] is None


def test_monthly_fit_equals_least_squares(spark):
    means = [float(v) for v in np.random.default_rng(3).normal(size=12)]
    df = spark.createDataFrame([(1, means), (2, means[:5] + [None] * 7)], "k INT, m ARRAY<DOUBLE>")
    got = {r["k"]: r for r in harmonic.harmonic_fit_monthly(df, "m", "p", "_10y").collect()}
    t = (np.arange(1, 13) - 0.5) / 12
    beta = np.linalg.lstsq(design(t), np.array(means), rcond=None)[0]
    assert [got[1][f"p_{c}_10y"] for c in harmonic.COEFFICIENTS] == pytest.approx(list(beta), abs=1e-8)
    assert got[1]["p_tcoef_10y"] == got[1]["p_trend_10y"]
    assert got[2]["p_beta0_10y"] is None


def test_fire_frequency_divides_by_six_years(spark):
    rows = [(1, day("2006-08-01"), 0), (1, day("2007-08-01"), 200), (1, day("2007-09-01"), 0), (1, day("2009-08-01"), 7), (2, day("2007-08-01"), None)]
    burn = spark.createDataFrame(rows, "cell_id BIGINT, ts TIMESTAMP_NTZ, burn_date INT")
    targets = distinct_targets(
        spark.createDataFrame([(1, dt.date(2010, 6, 1)), (2, dt.date(2010, 6, 1))], "cell_id BIGINT, cutoff DATE")
    )
    got = {r["cell_id"]: r["fire_freq_win"] for r in fire_frequency(burn, targets).collect()}
    assert got == {1: pytest.approx(2 / 6), 2: None}


def test_optional_quality_band(spark):
    df = spark.createDataFrame([(1, day("2010-01-01"), 10)], "cell_id BIGINT, ts TIMESTAMP_NTZ, et INT")
    assert evapotranspiration(df).first()["ET"] == pytest.approx(1.0)
    assert evapotranspiration(df.withColumn("et_qc", F.lit(3))).first()["ET"] is None


def test_bare_soil_without_clear_pixels(spark):
    base = dict(cell_id=1, ts=day("2010-01-01"), blue=0.06, green=0.08, red=0.1, nir=0.13, swir1=0.2, swir2=0.19)
    rows = [dict(base, pixel_qa=64), dict(base, cell_id=2, pixel_qa=8), dict(base, cell_id=3, pixel_qa=64)]
    schema = "cell_id BIGINT, ts TIMESTAMP_NTZ, " + ", ".join(f"{b} DOUBLE" for b in "blue green red nir swir1 swir2".split()) + ", pixel_qa INT"
    df = spark.createDataFrame(rows, schema)
    targets = distinct_targets(spark.createDataFrame([(c, dt.date(2010, 6, 1)) for c in (1, 2, 3)], "cell_id BIGINT, cutoff DATE"))
    land = spark.createDataFrame([(1, True), (2, True), (3, False)], "cell_id BIGINT, on_land BOOLEAN")
    got = {r["cell_id"]: r for r in bare_soil(soil_flags(df), targets, "1y", land).collect()}
    assert got[1]["SF_median"] == 1.0 and got[1]["red_median"] == pytest.approx(0.1)
    assert got[2]["SF_median"] is None and got[2]["red_median"] is None
    assert got[3]["SF_median"] is None and got[3]["red_median"] is None


def test_window_bounds(spark):
    df = spark.createDataFrame([(dt.date(2012, 2, 29),), (dt.date(2012, 6, 1),)], "cutoff DATE")
    w = cutoff_windows(F.col("cutoff"))
    first, second = df.select(w["1y"][0], w["spring"][0], w["spring"][1], w["clim10"][0]).collect()
    assert list(first) == [dt.date(2011, 2, 28), dt.date(2011, 3, 1), dt.date(2011, 6, 1), dt.date(2002, 1, 1)]
    assert second[1] == dt.date(2012, 3, 1)


@pytest.mark.parametrize("hot_rows", [1_000_000, 200])
def test_quantiles_with_ties(spark, hot_rows):
    """Four of five values are one and the same; two value columns, the second with gaps."""
    rng = np.random.default_rng(8)
    n = 3000
    v = np.where(rng.random(n) < 0.8, 5.0, rng.normal(5, 2, n).round(2))
    w = np.where(rng.random(n) < 0.3, np.nan, rng.integers(0, 4, n))
    days = pd.Timestamp("2009-01-01") + pd.to_timedelta(rng.integers(0, 700, n), "D")
    frame = pd.DataFrame({"cell_id": rng.choice([1, 1, 1, 2], n), "ts": days, "v": v, "w": w})
    rows = [(int(c), t.to_pydatetime(), float(a), None if np.isnan(b) else float(b)) for c, t, a, b in frame.itertuples(index=False)]
    series = spark.createDataFrame(rows, "cell_id BIGINT, ts TIMESTAMP_NTZ, v DOUBLE, w DOUBLE")
    cutoffs = [dt.date(2010, 3, 1), dt.date(2010, 6, 17), dt.date(2010, 11, 30), dt.date(2030, 1, 1)]
    targets = distinct_targets(spark.createDataFrame([(c, d) for c in (1, 2, 3) for d in cutoffs], "cell_id BIGINT, cutoff DATE"))
    probs = (0.0, 0.1, 0.5, 0.9, 1.0)
    got = {(r["cell_id"], r["cutoff"]): r for r in window_quantiles(series, targets, "1y", ["v", "w"], probs, hot_rows).collect()}
    assert len(got) == 6
    for (cell, cutoff), row in got.items():
        values = inside(frame, cell, cutoff, "1y")
        for name in ("v", "w"):
            assert row[name] == pytest.approx(list(np.quantile(values[name].dropna(), probs)), abs=1e-12)


def jobs(spark, work):
    """Jobs that ``work`` starts."""
    spark.sparkContext.setJobGroup("counted", "counted")
    try:
        result = work()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return result, len(spark.sparkContext.statusTracker().getJobIdsForGroup("counted"))


def plan_of(df):
    """The plan that ran."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("\n+- == Initial Plan")[0]


def exchanges_of_counts(plan):
    """The exchanges of counts by value, made or used again; a stage may be shown only where it is reused."""
    return set(re.findall(r"Exchange hashpartitioning\(cell_id#\w+, k#\w+, day#\w+, v#.*?\[plan_id=(\d+)\]", plan))


def test_no_join_sends_a_hot_cell_to_one_task(data):
    """The counts of a cell are joined with its cuts in parts, whether or not these are broadcast."""
    series, targets, *_ = data
    found = window_quantiles(series, targets, "1y", ["v"], (0.25, 0.75), hot_rows=10)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"Join LeftSemi, [^\n]*\(part#\d+L? = part#\d+L?\)", plan)
    assert re.search(r"Join Inner, [^\n]*\(part#\d+L? = part#\d+L?\)", plan)


def test_quantiles_run_nothing_beforehand(data, spark, tmp_path):
    series, targets, *_ = data
    series.write.parquet(str(tmp_path / "series"))
    stored = spark.read.parquet(str(tmp_path / "series"))
    found, n = jobs(spark, lambda: window_quantiles(stored, targets, "1y", ["v"], (0.25, 0.75), 500))
    assert n == 0
    final = plan_of(found)
    # The counts by value have one exchange; every other reader of them uses it again.
    assert len(exchanges_of_counts(final)) == 1 and final.count("ReusedExchange") >= 3


def scans(plan):
    return len(re.findall(r"FileScan parquet .*\bts#", plan))


def test_a_dataset_is_scanned_once_and_once_for_quartiles(spark, data, tmp_path, monkeypatch):
    """Sums, harmonic moments and image dates share a scan; only quartiles take another."""
    series, targets, pandas, points = data
    path = str(tmp_path / "series")
    series.withColumn("w", F.col("v") * 2).write.parquet(path)
    plans, stored = [], blocks.stored
    for module in (blocks, covariates):
        monkeypatch.setattr(module, "stored", lambda df: plans.append(plan_of(df)) or stored(df))
    stats = [Stat("v_mean", "v", "mean", "1y"), Stat("w_sum", "w", "sum", "5y")]
    family = series_family(spark.read.parquet(path), targets, stats, ["v", "w"], ["v"])
    # The shared table, then the quartiles; what is joined in the end reads stored tables only.
    assert [scans(p) for p in plans] == [1, 1]
    assert scans(plan_of(family)) == 0
    # The same as by separate scans.
    alone = window_stats(series.withColumn("w", F.col("v") * 2), targets, stats)
    fits = harmonic.harmonic_fit(series, targets, "10y", {"v": "v"})
    got = {(r["cell_id"], r["cutoff"]): r for r in family.collect()}
    for row in alone.collect():
        same = got[row["cell_id"], row["cutoff"]]
        assert same["w_sum"] == pytest.approx(row["w_sum"]) and same["v_mean"] == pytest.approx(row["v_mean"])
    for row in fits.collect():
        assert got[row["cell_id"], row["cutoff"]]["v_a1"] == pytest.approx(row["v_a1"])


def test_images_of_other_cells_count(spark):
    """A time counts as an image though no target's cell has a row in it."""
    rows = [(1, day("2010-01-05"), 1.0), (2, day("2010-01-05"), 1.0), (2, day("2010-02-07"), None), (3, day("2001-02-07"), 2.0)]
    series = spark.createDataFrame(rows, "cell_id BIGINT, ts TIMESTAMP_NTZ, v DOUBLE")
    targets = distinct_targets(spark.createDataFrame([(1, dt.date(2010, 6, 17))], "cell_id BIGINT, cutoff DATE"))
    stats = [Stat("s", "v", "sum", "10y"), Stat("t", "v", "max", "1y")]
    shared = blocks.shared_partials(series, targets, stats)
    images = blocks.images_of(shared)
    assert sorted(r["ts"].isoformat()[:10] for r in images.collect()) == ["2001-02-07", "2010-01-05", "2010-02-07"]
    counts = {w: blocks.image_counts(images, targets, w).first()["n_images"] for w in ("1y", "10y")}
    assert counts == {"1y": 2, "10y": 3}
    row = window_stats(series, targets, stats, shared=shared).first()
    assert (row["s"], row["t"]) == (1.0, 1.0)


def test_tables_on_the_way_are_removed(spark):
    """A stored result leaves nothing of what was stored to make it, other tables stay."""
    import glob

    from loamline.session import scratch_dir, stored, stored_alone

    kept = stored(spark.range(3))
    before = set(glob.glob(f"{scratch_dir(spark).removeprefix('file:')}/*"))

    def made():
        return stored(spark.range(6)).groupBy((F.col("id") % 2).alias("k")).count().join(stored(spark.range(2)), F.col("k") == F.col("id"))

    table = stored_alone(spark, made)
    after = set(glob.glob(f"{scratch_dir(spark).removeprefix('file:')}/*"))
    assert before < after and len(after - before) == 1
    assert table.count() == 2 and kept.count() == 3
