import datetime as dt
import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from checks import evaluation
from loamline.operators import conformal, metrics, quantiles, rank

PROBS = (0.0, 0.01, 0.25, 0.5, 0.9, 1.0)


def frame(spark, values):
    return spark.createDataFrame([(float(v) if v is not None else None,) for v in values], "v DOUBLE")


@pytest.fixture
def small_steps(monkeypatch):
    """Bounds so tight that every step of the search is taken."""
    monkeypatch.setattr(quantiles, "_FETCH", 3)


SAMPLES = {
    "normal": np.random.default_rng(1).normal(size=6000),
    "ties": np.random.default_rng(2).integers(0, 3, 6000),
    "one value": np.ones(50),
    "a third equal": np.concatenate([np.zeros(2000), np.random.default_rng(3).lognormal(3, 3, 4000)]),
    "single": [4.0],
    "outliers": [-1e300, 1e300, 0.0, 1.0, 2.0],
}


@pytest.mark.parametrize("name", list(SAMPLES))
def test_global_quantiles(spark, name, small_steps):
    values = SAMPLES[name]
    df = frame(spark, [*values, None, float("nan")])
    got = quantiles.quantiles(df, {"v": F.col("v")}, PROBS)["v"]
    assert got == pytest.approx(list(np.quantile(values, PROBS)))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(-100, 100, width=32), min_size=1, max_size=40), st.data())
def test_order_statistics_of_any_list(spark, values, data):
    at = data.draw(st.integers(0, len(values) - 1))
    n, found = quantiles.order_statistics(frame(spark, values), {"v": F.col("v")}, lambda n: [at])["v"]
    assert n == len(values) and found[at] == sorted(values)[at]


def test_quantiles_without_a_round_of_narrowing(spark, monkeypatch):
    """What brackets leave open is ranked, so the search ends whatever the sketches say."""
    monkeypatch.setattr(quantiles, "_ROUNDS", 0)
    values = SAMPLES["a third equal"]
    got = quantiles.quantiles(frame(spark, [*values, None]), {"v": F.col("v")}, PROBS)["v"]
    assert got == pytest.approx(list(np.quantile(values, PROBS)))


def test_quantiles_of_nothing(spark):
    assert quantiles.quantiles(frame(spark, [None]), {"v": F.col("v")}, (0.5,)) == {"v": [None]}


@pytest.mark.parametrize("hot_rows", [10**6, 100])
def test_group_quantiles(spark, hot_rows):
    rng = np.random.default_rng(5)
    rows = [("big", float(v)) for v in np.round(rng.normal(size=900), 1)]
    rows += [("ties", float(v)) for v in rng.integers(0, 2, 400)] + [("small", 1.0), ("small", 2.0)]
    df = spark.createDataFrame(rows, "g STRING, v DOUBLE")
    got = quantiles.group_quantiles(df, ["g"], ["v"], (0.25, 0.5, 0.9), hot_rows)
    for row in got.collect():
        values = [v for g, v in rows if g == row["g"]]
        assert row["v"] == pytest.approx(list(np.quantile(values, (0.25, 0.5, 0.9))))


def test_positions_are_global(spark):
    df = spark.range(1000).withColumn("k", (F.col("id") * 7919) % 1000)
    got = rank.global_position(df, ["k"]).where("position <> k").count()
    assert got == 0
    totals = rank.running_total(df.withColumn("w", F.lit(2)), ["k"], "w").where("running <> 2 * (k + 1)")
    assert totals.count() == 0


def test_point_ids_follow_date_then_place(spark):
    day = dt.date(2011, 1, 1)
    rows = [(2.0, 1.0, day), (1.0, 5.0, day), (1.0, 5.0, day), (9.0, 9.0, dt.date(2010, 1, 1))]
    points = rank.assign_point_ids(
        spark.createDataFrame(rows, "lat DOUBLE, lon DOUBLE, covariate_cutoff_date DATE"), "p"
    )
    got = {r["point_id"]: (r["lat"], r["lon"]) for r in points.collect()}
    assert got == {"p_000001": (9.0, 9.0), "p_000002": (1.0, 5.0), "p_000003": (2.0, 1.0)}


def test_folds_keep_groups_whole_and_balanced(spark):
    rows = [(f"s{i % 37}", i) for i in range(1000)] + [(None, 0)] + [("hot", i) for i in range(500)]
    folded = rank.group_folds(spark.createDataFrame(rows, "site STRING, i INT"), "site", 5)
    per_site = folded.groupBy("site").agg(F.count_distinct("fold").alias("n")).where("n > 1")
    assert per_site.count() == 0 and folded.count() == 1500
    groups = [r["n"] for r in folded.groupBy("fold").agg(F.count_distinct("site").alias("n")).collect()]
    assert len(groups) == 5 and max(groups) - min(groups) <= 1


def test_systematic_sample(spark):
    df = spark.range(1300).withColumn("v", -F.col("id"))
    got = sorted(r["id"] for r in rank.systematic_sample(df, "v", ["id"], 600).collect())
    assert got == sorted(range(1299, -1, -2))


@pytest.mark.parametrize("n, at", [(25705, 23136), (79360, 71425), (16434, 14792)])
def test_rank_of_published_sizes(n, at):
    assert conformal.conformal_rank(n) == at


@pytest.mark.parametrize("n", [1, 5, 9, 10, 100, 1310])
def test_multiplier_equals_the_higher_quantile(spark, n):
    values = np.random.default_rng(n).lognormal(size=n)
    df = frame(spark, values).select(F.col("v").alias("observed"), F.lit(0.0).alias("predicted"), F.lit(1.0).alias("scale"))
    got = conformal.conformal_multiplier(df)
    level = min(1.0, math.ceil((n + 1) * 0.9) / n)
    assert got["multiplier"] == np.quantile(values, level, method="higher")
    covered = (values <= got["multiplier"]).mean()
    assert covered == pytest.approx((got["rank"] + 1) / n)


def test_tied_scores_and_zero_scale(spark):
    rows = [(1.0, 0.0, 1.0)] * 30 + [(5.0, 0.0, 0.0), (2.0, None, 1.0)]
    df = spark.createDataFrame(rows, "observed DOUBLE, predicted DOUBLE, scale DOUBLE")
    got = conformal.conformal_multiplier(df)
    assert (got["multiplier"], got["n"]) == (1.0, 30)


def test_regression_metrics_edges(spark):
    rows = [("a", 1.0, 1.5), ("a", 3.0, 2.0), ("a", None, 1.0), ("a", 1.0, float("nan")), ("b", 1.0, 2.0),
            ("c", 2.0, 2.0), ("c", 2.0, 2.0), ("d", 2.0, 1.0), ("d", 2.0, 2.0)]
    df = spark.createDataFrame(rows, "g STRING, observed DOUBLE, predicted DOUBLE")
    got = {r["g"]: r for r in metrics.regression_metrics(df, ["g"]).collect()}
    assert got["a"]["n"] == 2 and got["a"]["r2"] == pytest.approx(1 - (0.25 + 1) / 2)
    assert got["a"]["bias"] == pytest.approx(-0.25)
    assert got["b"]["r2"] is None and got["c"]["r2"] == 1.0 and got["d"]["r2"] == 0.0


def test_subgroups_need_thirty_rows(spark):
    rows = [("x", 1.0 * i, 1.0) for i in range(29)] + [(None, 1.0 * i, 1.0) for i in range(30)]
    df = spark.createDataFrame(rows, "g STRING, observed DOUBLE, predicted DOUBLE")
    assert [r["g"] for r in metrics.subgroup_metrics(df, "g").collect()] == [None]


def test_interval_metrics_count_bounds_as_covered(spark):
    rows = [(1.0, 1.0, 1.0, 2.0), (2.0, 1.0, 1.0, 2.0), (3.0, 1.0, 1.0, 2.0), (None, 1.0, 1.0, 2.0)]
    df = spark.createDataFrame(rows, "observed DOUBLE, predicted DOUBLE, lower_90 DOUBLE, upper_90 DOUBLE")
    row = metrics.interval_metrics(df).first()
    assert (row["n"], row["coverage_90"], row["median_interval_width"]) == (3, pytest.approx(2 / 3), 1.0)


def test_pixel_depth_keeps_missing_depth(spark):
    rows = [(40.0, -100.0, 5.0, 1.0, 2.0), (40.0, -100.0, 9.9, 3.0, 2.0), (40.0, -100.0, None, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "lat DOUBLE, lon DOUBLE, z_mid DOUBLE, observed DOUBLE, predicted DOUBLE")
    got = {r["depth_bin_10cm"]: (r["observed"], r["n_horizons"]) for r in metrics.pixel_depth(df).collect()}
    assert got == {0: (2.0, 2), None: (1.0, 1)}


def test_histogram_covers_all_values(spark):
    df = frame(spark, list(range(101)) + [None])
    rows = metrics.histogram(df, "v", 10, None).orderBy("bin").collect()
    assert sum(r["n"] for r in rows) == 101 and rows[0]["low"] == 0 and rows[-1]["high"] == 100
    ends = metrics.histogram(frame(spark, [0.0, 1.0]), "v", 4, None).orderBy("bin").collect()
    assert [(r["bin"], r["low"], r["n"]) for r in ends] == [(0, 0, 1), (1, 0.25, 0), (2, 0.5, 0), (3, 0.75, 1)]
    same = metrics.histogram(frame(spark, [2.0, 2.0]), "v", 10).collect()
    assert [(r["bin"], r["n"]) for r in same] == [(0, 2)]


def test_sample_fetches_whole_rows(spark):
    df = spark.range(1000).selectExpr("id", "CAST(id % 40 AS DOUBLE) AS v", "concat('row ', id) AS wide", "IF(id = 3, NULL, id) AS tie")
    got = sorted(r["id"] for r in rank.systematic_sample(df, "v", ["tie", "id"], 100).collect())
    order = sorted(range(1000), key=lambda i: (float(i % 40), i != 3, i))
    assert got == sorted(order[::10])
    final = rank.systematic_sample(df, "v", ["id"], 100)
    assert final.columns == df.columns


@pytest.mark.parametrize("limit", [10_000, 2])
def test_first_rows(spark, monkeypatch, limit):
    monkeypatch.setattr(rank, "TOP_ROWS", limit)
    df = spark.range(300).selectExpr("id", "IF(id % 7 = 0, NULL, id % 10) AS k", "concat('r', id) AS wide")
    want = sorted(range(300), key=lambda i: (i % 7 != 0, 0 if i % 7 == 0 else i % 10, i))
    for n in (1, 50, 300, 400):
        assert sorted(r["id"] for r in rank.first_rows(df, ["k", "id"], n).collect()) == sorted(want[:n])


def test_profile_counts(spark):
    from loamline.operators import cleaning

    rows = [(i % 5, None if i % 4 == 0 else f"t{i % 9}", float("nan") if i % 2 else -0.0 if i % 3 else 0.0, dt.date(2000, 1, 1 + i % 3), None)
            for i in range(200)]
    df = spark.createDataFrame(rows, "a INT, b STRING, c DOUBLE, d DATE, e INT")
    got = {r["column_name"]: (r["dtype"], r["non_missing"], r["missing"], r["distinct_values"]) for r in cleaning.profile(df).collect()}
    assert got == {
        "a": ("int", 200, 0, 5), "b": ("string", 150, 50, 9), "c": ("double", 200, 0, 2), "d": ("date", 200, 0, 3), "e": ("int", 0, 200, 0),
    }
    rough = {r["column_name"]: r["distinct_values"] for r in cleaning.profile(df, exact=False).collect()}
    assert rough == {"a": 5, "b": 9, "c": 2, "d": 3, "e": 0}
    plan = cleaning.profile(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "cast(a" not in plan and cleaning.profile(df.limit(0)).count() == 0


def test_scratch_is_one_folder_with_an_end(spark, monkeypatch, tmp_path):
    from loamline import session

    assert session.scratch_dir(spark).endswith(spark.sparkContext.applicationId)
    folder = tmp_path / "scratch"
    monkeypatch.setattr(session, "scratch_dir", lambda _: str(folder))
    df = session.stored(spark.range(7).withColumn("v", F.col("id") * 2))
    assert df.count() == 7 and len(list(folder.iterdir())) == 1
    session.clear_scratch(spark)
    assert not folder.exists() and session.stored(spark.range(3)).count() == 3


def test_subgroup_query_has_every_part(spark, tmp_path):
    """Parts are groups of their own, however many there are."""
    spark.sql(
        """SELECT p AS l_orderkey, 1 AS l_linenumber, p * 97 AS l_partkey, 2L AS l_suppkey, 0.0D AS l_discount, id + 1.0D AS l_quantity,
                  0.0D AS l_tax, 9000D * id AS l_extendedprice, 'N' AS l_returnflag
           FROM range(30) JOIN (SELECT id AS p FROM range(1, 4)) ON true"""
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    found = evaluation.subgroup_metrics(spark, str(tmp_path)).collect()
    assert sorted((r["grp"], r["n"]) for r in found) == [(97, 30), (194, 30), (291, 30)]


def test_quantiles_without_a_part(spark):
    import pandas as pd

    rng, n = np.random.default_rng(1), 40_000
    wide = rng.normal(size=n) * 10.0 ** rng.integers(-200, 200, n)
    some = np.where(rng.random(n) < 0.3, np.nan, rng.normal(size=n))
    part = rng.integers(1, 6, n)
    data = {"wide": wide, "few": rng.integers(0, 5, n) - 2.0, "some": some, "none": np.full(n, np.nan)}
    df = spark.createDataFrame(pd.DataFrame(data | {"part": part})).repartition(5)
    outs = [1, 2, 5, None]
    for out, got in zip(outs, quantiles.quantiles_without(df, {c: F.col(c) for c in data}, F.col("part"), outs)):
        for c, values in data.items():
            kept = values[(part != out) & ~np.isnan(values)]
            want = np.median(kept) if len(kept) else None
            assert got[c][1] == len(kept) and (got[c][0] == want or got[c][0] == pytest.approx(want, rel=1e-12))
